"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

A text is cut at the vocabulary's special strings and then into pre-tokens. The bytes of a
pre-token are its first symbols. A segment tree holds, for each adjacent pair of symbols, its
merge rank and place; the root is the lowest rank, of equal ones the leftmost. That pair is
merged, three leaves change (the pair itself, the one it used up, the one before), and each
change walks up the tree, until the root says that nothing can be merged: n log n steps for n
bytes, however long a pre-token is. Decoding joins the bytes of the ids; sequences that are
no UTF-8 become replacement characters.

How it runs. One pass in tasks, no shuffle, no broadcast: a worker reads the vocabulary file
once and keeps the ids of short pre-tokens in a bounded table. The short pre-tokens of a
few texts that are not in the table are merged together, one tree per row of an array; a
longer one has a tree of its own.

Defined results: null and empty texts have no ids and decode to an empty text. Special strings
inside texts are tokens of their own unless ``plain`` is set. Rows with the same doc_id are
encoded one by one, null ids too. An empty table gives an empty result. Texts of any length
are encoded whole. Other columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.common import strings
from ledgerloom.llm.token_counts import PRETOKEN, SAFE, default_path

#: Pre-tokens that a worker keeps, and the longest one kept.
CACHE_SIZE, CACHED_LENGTH = 300_000, 64
#: Rows merged together, and the fewest that are worth it.
ROWS, ROWS_FROM = 8192, 64
#: A tree value is rank << PLACE | place.
PLACE = 40
_NOTHING = 1 << 62


def byte_characters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable Latin-1 itself, others from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class PairTree:
    """The ranks of the adjacent pairs of a symbol sequence: lowest, then leftmost, at the root."""

    def __init__(self, values: list[int]):
        self.size = 1 << max(len(values) - 1, 0).bit_length()
        tree = [_NOTHING] * self.size + values + [_NOTHING] * (self.size - len(values))
        for i in range(self.size - 1, 0, -1):
            left, right = tree[2 * i], tree[2 * i + 1]
            tree[i] = left if left < right else right
        self.tree = tree

    def put(self, place: int, value: int) -> None:
        tree, i = self.tree, self.size + place
        tree[i] = value
        i >>= 1
        while i:
            left, right = tree[2 * i], tree[2 * i + 1]
            least = left if left < right else right
            if tree[i] == least:
                return
            tree[i] = least
            i >>= 1


class Encoder:
    """Ids of texts by one vocabulary file, and texts of ids."""

    def __init__(self, path: str | None = None, plain: bool = False, cache_size: int = CACHE_SIZE):
        from tokenizers import pre_tokenizers

        with open(path or default_path(), encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        characters = byte_characters()
        self.byte_of = {c: b for b, c in enumerate(characters)}
        self.first = [vocab[c] for c in characters]
        self.shift = (max(vocab.values()) + 1).bit_length()
        self.first_ids = np.array(self.first, np.int64)
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[vocab[a] << self.shift | vocab[b]] = rank << PLACE
            self.merged.append(vocab[a + b])
        self.merged_ids = np.array([*self.merged, 0], np.int64)
        self.pairs = np.array(sorted(self.ranks), np.int64)
        self.pair_ranks = np.array([self.ranks[x] for x in self.pairs.tolist()], np.int64)
        self.bytes_of = {i: self._bytes(token) for token, i in vocab.items()}
        self.special = {} if plain else {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("special tokens that take in their surroundings are not supported")
        self.bytes_of.update({t["id"]: self._bytes(t["content"]) for t in spec["added_tokens"]})
        self.cut_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.cutter = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.cache_size = cache_size
        self.known: dict[str, bytes] = {}  # packed ids by pre-token
        of_id = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self.tokens = pa.array(of_id, pa.large_binary())

    def _bytes(self, token: str) -> bytes:
        """A token's bytes; one with characters that stand for no byte is its own UTF-8."""
        try:
            return bytes(map(self.byte_of.__getitem__, token))
        except KeyError:
            return token.encode("utf-8")

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token."""
        symbols = [self.first[b] for b in data]
        n = len(symbols)
        if n < 2:
            return symbols
        ranks, shift, merged = self.ranks, self.shift, self.merged
        pairs = [ranks.get(a << shift | b, _NOTHING) for a, b in zip(symbols, symbols[1:])]
        tree = PairTree([v | place if v != _NOTHING else v for place, v in enumerate(pairs)])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while (top := tree.tree[1]) != _NOTHING:
            at = top & ((1 << PLACE) - 1)
            used = after[at]
            new = symbols[at] = merged[top >> PLACE]
            symbols[used] = -1
            following = after[at] = after[used]
            if used < n - 1:
                tree.put(used, _NOTHING)
            if following < n:
                before[following] = at
                rank = ranks.get(new << shift | symbols[following], _NOTHING)
                tree.put(at, rank | at if rank != _NOTHING else rank)
            else:
                tree.put(at, _NOTHING)
            last = before[at]
            if last >= 0:
                rank = ranks.get(symbols[last] << shift | new, _NOTHING)
                tree.put(last, rank | last if rank != _NOTHING else rank)
        return [s for s in symbols if s >= 0]

    def values(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Tree values of pairs of symbols; negative symbols make no pair."""
        if not len(self.pairs):
            return np.full(left.shape, _NOTHING)
        pair = left << self.shift | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        found = (self.pairs[at] == pair) & (left >= 0) & (right >= 0)
        return np.where(found, self.pair_ranks[at] | place, _NOTHING)

    def merge_rows(self, words: list[bytes], size: int) -> list[bytes]:
        """Packed ids of pre-tokens of at most ``size`` bytes (a power of two): a row and a tree for each."""
        count, n = len(words), np.array([len(w) for w in words])
        symbols = np.full((count, size + 1), -1, np.int64)  # the last column ends the longest
        symbols[:, :size][np.arange(size) < n[:, None]] = self.first_ids[np.frombuffer(b"".join(words), np.uint8)]
        places = np.arange(size)
        after = np.tile(np.arange(1, size + 2), (count, 1))
        before = np.tile(np.arange(-1, size), (count, 1))
        tree = np.empty((count, 2 * size), np.int64)
        tree[:, size:] = self.values(symbols[:, :-1], symbols[:, 1:], places)
        level = size
        while level > 1:
            level //= 2
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])

        width = size + 1
        symbol, nodes, next_, last_ = symbols.ravel(), tree.ravel(), after.ravel(), before.ravel()

        def put(first: np.ndarray, place: np.ndarray, value: np.ndarray | int) -> None:
            """Set leaves and what stands above them; ``first``: where the rows' trees begin."""
            node = place + size
            nodes[first + node] = value
            for _ in range(size.bit_length() - 1):
                node >>= 1
                below = first + 2 * node
                nodes[first + node] = np.minimum(nodes[below], nodes[below + 1])

        rows = np.arange(count)
        while len(rows := rows[nodes[rows * (2 * size) + 1] != _NOTHING]):
            first, base = rows * (2 * size), rows * width
            top = nodes[first + 1]
            at = top & ((1 << PLACE) - 1)
            here = base + at
            used = next_[here]
            new = self.merged_ids[top >> PLACE]
            symbol[here] = new
            symbol[base + used] = -1
            following = next_[base + used]
            next_[here] = following
            last_[base + following] = at
            put(first, used, _NOTHING)
            put(first, at, self.values(new, symbol[base + following], at))
            some = np.flatnonzero(last_[here] >= 0)
            last = last_[here[some]]
            put(first[some], last, self.values(symbol[base[some] + last], new[some], last))
        left = symbols >= 0
        flat, ends = symbols[left].astype("<i4").tobytes(), (4 * np.cumsum(left.sum(1))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def learn(self, pretokens: Iterable[str]) -> dict[str, bytes]:
        """The packed ids of pre-tokens, many at a time; the table keeps those of short ones."""
        sized: dict[int, tuple[list[str], list[bytes]]] = {}
        out: dict[str, bytes] = {}
        for p in pretokens:
            data = p.encode("utf-8")
            names, words = sized.setdefault(1 << max(len(data) - 1, 1).bit_length(), ([], []))
            names.append(p)
            words.append(data)
        for size, (names, words) in sized.items():
            if size > CACHED_LENGTH or len(words) < ROWS_FROM:
                out.update((p, np.array(self.merge(w), "<i4").tobytes()) for p, w in zip(names, words))
                continue
            for at in range(0, len(words), ROWS):
                out.update(zip(names[at : at + ROWS], self.merge_rows(words[at : at + ROWS], size)))
        short = {p: ids for p, ids in out.items() if len(p) <= CACHED_LENGTH}
        if len(self.known) + len(short) > self.cache_size:
            self.known.clear()
        if len(short) <= self.cache_size:
            self.known.update(short)
        return out

    def pretokens(self, text: str) -> list[str]:
        if SAFE.fullmatch(text):
            return PRETOKEN.findall(text)
        # Characters that pattern engines put into different classes: the library's own cut.
        return [bytes(map(self.byte_of.__getitem__, piece)).decode("utf-8") for piece, _ in self.cutter.pre_tokenize_str(text)]

    def _cut(self, text: str) -> list[str | int]:
        """Pre-tokens, and the ids of special strings."""
        if self.cut_special is None or not any(s in text for s in self.special):
            return self.pretokens(text)
        return [x for part in self.cut_special.split(text) for x in ([self.special[part]] if part in self.special else self.pretokens(part))]

    def packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as 32-bit numbers in a row."""
        known, cut = self.known, list(map(self._cut, texts))
        found = [list(map(known.get, pieces)) for pieces in cut]
        open_ = {p for pieces, ids in zip(cut, found) if None in ids for p, x in zip(pieces, ids) if x is None}
        if open_:
            new = self.learn(p for p in open_ if isinstance(p, str))
            new.update((i, np.array([i], "<i4").tobytes()) for i in open_ if isinstance(i, int))
            found = [[new[p] if x is None else x for p, x in zip(pieces, ids)] if None in ids else ids for pieces, ids in zip(cut, found)]
        return list(map(b"".join, found))

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text."""
        return [np.frombuffer(x, "<i4").tolist() for x in self.packed(texts)]

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def decode_all(self, ids: pa.ListArray) -> list[str]:
        """The texts of lists of ids; null lists are empty. The bytes of all ids are put in a row, then cut."""
        lists = ids.fill_null([]) if ids.null_count else ids
        spelt = self.tokens.take(lists.flatten())
        ends = np.frombuffer(spelt.buffers()[1], np.int64)[spelt.offset :]
        data = (spelt.buffers()[2] or pa.py_buffer(b"")).to_pybytes()
        counts = np.cumsum([0, *lists.value_lengths().to_pylist()])
        at = ends[counts].tolist() if len(spelt) else [0] * len(counts)
        return [data[i:j].decode("utf-8", "replace") for i, j in zip(at, at[1:])]

    def decode(self, ids: Iterable[int]) -> str:
        return self.decode_all(pa.array([list(ids)], pa.list_(pa.int32())))[0]


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str | None, plain: bool = False, cache_size: int = CACHE_SIZE) -> Encoder:
    """The worker's encoder for a file, read once."""
    key = (path, plain, cache_size)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def encode(docs: DataFrame, path: str | None = None, plain: bool = False, cache_size: int = CACHE_SIZE, decoded: bool = False) -> DataFrame:
    """Per document: doc_id, ids; with ``decoded`` also text, made from the ids in the same pass.

    ``path``: a vocabulary file that workers can open; ``plain``: special strings are text.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, plain, cache_size)
        for batch in slices(batches):
            packed = own.packed(strings(batch.column("text")))
            ends = np.cumsum([0, *map(len, packed)]) // 4
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(packed), "<i4")))
            columns = [batch.column("doc_id"), ids, *([pa.array(own.decode_all(ids), pa.string())] if decoded else [])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "text"][: len(columns)])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>{', text string' if decoded else ''}")


def decode(encoded: DataFrame, path: str | None = None, cache_size: int = CACHE_SIZE) -> DataFrame:
    """The columns doc_id, ids and text, the text made from the ids; null ids are none."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, cache_size=cache_size)
        for batch in batches:
            texts = own.decode_all(batch.column("ids"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, ids array<int>, text string")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that the ids of few texts are held at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
