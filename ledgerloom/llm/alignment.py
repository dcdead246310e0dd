"""Cross-tokenizer alignment: the tokens of two vocabularies linked where their bytes overlap.

A text is tokenised whole by both vocabularies, A by byte-level BPE over a space and the text, B by
a piece model that adds the space itself. Both token sequences must spell the same bytes.
Anchors are the byte offsets at which a token of A and one of B both begin with a space: ends
shared by both sides, verified by their offsets. They split a document into windows, each a
pair of id tuples. A window's alignment, the groups of tokens between shared ends, depends on
those tuples alone and is memoised by them. Two tokens are linked if they overlap: a link begins
wherever a token of either side does.

How it runs. The first pass tokenises every text once, writes the ids, the groups' digest and
the number of links of each document, and the link counts of id pairs summed within the
task; a shuffle of those counts gives each pair's count over the corpus. The second pass
reads the written ids and adds up the counts of each document's links: those of the most
frequent pairs from a broadcast table of at most ``PAIRS`` entries; if there are more pairs, the
links that the table lacks are summed per document and id pair and joined.

A's ids come from a compiled encoder where it is known to give the same: a vocabulary whose ids
rise with the merge ranks and all of whose tokens its own merges reach, texts that both
pattern engines cut alike, pre-tokens of bounded length. Others go through ``bpe.Encoder``.

Defined results: null and empty texts, and those whose tokens do not spell the text on either
side, have no tokens: all numbers are zero, the groups empty. Special strings inside texts are
plain text. Rows with the same doc_id are aligned one by one, null ids too. An empty table gives
an empty result. Texts of any length are aligned whole. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.bpe import Encoder, slices
from ledgerloom.llm.common import FILE, ROW, Sent, located, rows_per_batch, saved, strings
from ledgerloom.llm.token_counts import PRETOKEN, SAFE

#: Entries of the broadcast table of pair counts (17 bytes each).
PAIRS = 2_000_000
#: Documents handed to Python at a time.
BATCH = 200
#: Ids in the windows that a worker keeps; pairs that a task counts before it sends them on.
MEMO_IDS, FLUSH = 1_500_000, 400_000
#: Characters without a space, or spaces, beyond which a text is left to the encoder whose time does not grow with their square.
RUN = 1000
SPACE = "\u2581"
#: Stands between the ids of A and those of B in a window's key.
_OF_B = 1 << 24


class Ids:
    """Ids of texts in a row, and where each text's ids begin and the last ones end."""

    def __init__(self, values: np.ndarray, ends: np.ndarray):
        self.values, self.ends = values, ends

    @staticmethod
    def of(lists: list) -> Ids:
        """From lists or arrays."""
        ends = np.cumsum([0, *map(len, lists)])
        if lists and all(isinstance(x, np.ndarray) for x in lists):
            return Ids(np.concatenate(lists).astype(np.int64), ends)
        return Ids(np.fromiter(chain.from_iterable(lists), np.int64, int(ends[-1])), ends)

    @staticmethod
    def read(column: pa.ListArray) -> Ids:
        return Ids(column.flatten().to_numpy().astype(np.int64), np.append(0, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))))

    def column(self) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(self.ends, pa.int32()), pa.array(self.values.astype(np.int32)))


class Aligner:
    """Both vocabularies, and the windows aligned so far: their groups as text."""

    def __init__(self, path_a: str | None = None, path_b: str | None = None):
        from sentencepiece import SentencePieceProcessor

        self.a = Encoder(path_a, plain=True, cache_size=100_000)
        self.fast_a = compiled(self.a)
        self.b = SentencePieceProcessor(model_file=path_b or default_piece_path())
        bytes_b = [piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        of_a = [self.a.bytes_of.get(i, b"") for i in range(max(self.a.bytes_of) + 1)]
        self.lengths = tuple(np.array(list(map(len, x)), np.int64) for x in (of_a, bytes_b))
        self.spaced = tuple(np.array([x.startswith(b" ") for x in y]) for y in (of_a, bytes_b))
        self.spelling = tuple(pa.array(x, pa.large_binary()) for x in (of_a, bytes_b))
        # What an id adds to the groups' text: within its group, and at the end of its side.
        self.names = tuple(np.array([[f"{i},", f"{i}{end}"] for i in range(len(x))], object) for x, end in ((of_a, "|"), (bytes_b, ";")))
        self.memo: dict[bytes, str] = {}
        self.held = 0

    def encode_a(self, texts: list[str]) -> list[np.ndarray]:
        slow = [not (self.fast_a and SAFE.fullmatch(t) and bounded(t)) for t in texts]
        left = iter(self.a.packed([t for t, s in zip(texts, slow) if s]))
        return [np.frombuffer(next(left), "<i4") if s else self.fast_a.encode_to_numpy(t) for t, s in zip(texts, slow)]

    def tokenise(self, texts: list[str]) -> tuple[Ids, Ids]:
        """Ids of both sides, none where a side does not spell the text."""
        present = [t for t in texts if t]
        both = iter(zip(self.encode_a([" " + t for t in present]), self.b.encode(present, num_threads=1) if present else ()))
        none = (np.zeros(0, np.int64), [])
        lists = [next(both) if t else none for t in texts]
        a, b = Ids.of([x for x, _ in lists]), Ids.of([x for _, x in lists])
        spelt = [(" " + t).encode("utf-8") if t else b"" for t in texts]
        together = b"".join(spelt)
        ends = np.cumsum([0, *map(len, spelt)])
        right = [self.spells(x, side, together, ends) for side, x in enumerate((a, b))]
        if not (right[0].all() and right[1].all()):
            whole = (right[0] & right[1]).tolist()
            a, b = (Ids.of([x if w else none[i] for x, w in zip(side, whole)]) for i, side in enumerate(zip(*lists)))
        return a, b

    def spells(self, ids: Ids, side: int, together: bytes, ends: np.ndarray) -> np.ndarray:
        """Per text, whether its ids spell it; ``together``: all texts in a row."""
        at = np.append(0, np.cumsum(self.lengths[side][ids.values]))[ids.ends]
        found = self.spelling[side].take(pa.array(ids.values)).buffers()[2]
        found = found.to_pybytes()[: int(at[-1])] if found is not None else b""
        if found == together and (at == ends).all():
            return np.ones(len(ends) - 1, bool)
        return np.array([found[i:j] == together[k:m] for i, j, k, m in zip(at, at[1:], ends, ends[1:])], bool)

    def starts(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Byte offsets at which the tokens of A and B begin, and the end; texts in a row."""
        end_a, end_b = np.cumsum(self.lengths[0][a]), np.cumsum(self.lengths[1][b])
        return end_a - self.lengths[0][a], end_b - self.lengths[1][b], int(end_a[-1]) if len(a) else 0

    def windows(self, a: np.ndarray, b: np.ndarray) -> tuple[list[bytes], np.ndarray]:
        """Keys of the windows of texts in a row (ids of A, then ids of B), and the first A token of each."""
        start_a, start_b, end = self.starts(a, b)
        marked = np.zeros(end + 1, np.uint8)
        marked[start_a[self.spaced[0][a]]] = 1
        marked[start_b[self.spaced[1][b]]] += 1
        first_a, first_b = marked[start_a] == 2, marked[start_b] == 2
        cut_a, cut_b = np.flatnonzero(first_a), np.flatnonzero(first_b)
        key = np.empty(len(a) + len(b), np.int32)
        # Before a token of A stand the B tokens of earlier windows, before one of B the A tokens of its own, too.
        key[np.arange(len(a)) + cut_b[np.cumsum(first_a) - 1]] = a
        key[np.arange(len(b)) + np.append(cut_a[1:], len(a))[np.cumsum(first_b) - 1]] = b + _OF_B
        packed, at = key.tobytes(), (4 * np.append(cut_a + cut_b, len(key))).tolist()
        return [packed[i:j] for i, j in zip(at, at[1:])], cut_a

    def learn(self, keys: set[bytes]) -> None:
        """Align the windows that are not known yet, all in a row."""
        new = [k for k in keys if k not in self.memo]
        if self.held + sum(map(len, new)) // 4 > MEMO_IDS:
            self.memo.clear()
            self.held, new = 0, list(keys)
        if not new:
            return
        ids = np.frombuffer(b"".join(new), np.int32).astype(np.int64)
        of_b = ids >= _OF_B
        a, b = ids[~of_b], ids[of_b] - _OF_B
        start_a, start_b, end = self.starts(a, b)
        begins = np.zeros((2, end + 1), bool)
        begins[0, start_a] = begins[1, start_b] = begins[:, end] = True
        shared = begins[0] & begins[1]
        # A token ends its group where the next one begins at a shared offset. In the text, A's tokens of a group stand before B's.
        group_a, group_b = np.cumsum(shared[start_a]), np.cumsum(shared[start_b])
        last_a, last_b = shared[np.append(start_a[1:], end)].astype(int), shared[np.append(start_b[1:], end)].astype(int)
        before_b = np.searchsorted(group_b, group_a)  # B tokens of earlier groups
        before_a = np.searchsorted(group_a, group_b, side="right")
        parts = np.empty(len(ids), object)
        place_a = np.arange(len(a)) + before_b
        parts[place_a] = self.names[0][a, last_a]
        parts[np.arange(len(b)) + before_a] = self.names[1][b, last_b]
        parts = parts.tolist()
        token = (np.cumsum([0, *map(len, new)]) // 4).tolist()
        self.memo.update((key, "".join(parts[i:j])[:-1]) for key, i, j in zip(new, token, token[1:]))
        self.held += len(ids)

    def groups(self, a: Ids, b: Ids) -> np.ndarray:
        """Per text, how many groups it has: offsets at which tokens of both sides begin."""
        start_a, start_b, end = self.starts(a.values, b.values)
        begins = np.zeros(end + 1, bool)
        begins[start_b] = True
        return np.diff(np.append(0, np.cumsum(begins[start_a]))[a.ends])

    def forget(self) -> None:
        """Give the memory of all that is memoised back."""
        self.memo.clear()
        self.a.known.clear()
        self.held = 0

    def links(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of texts in a row: the id pair (a << 32 | b) of each link, in order."""
        start_a, start_b, end = self.starts(a, b)
        begins = np.zeros((2, end), bool)
        begins[0, start_a] = True
        begins[1, start_b] = True
        at = np.flatnonzero(begins[0] | begins[1])
        return a[np.cumsum(begins[0])[at] - 1] << 32 | b[np.cumsum(begins[1])[at] - 1]


def compiled(encoder: Encoder):
    """A compiled encoder for the same vocabulary, None if it might give other ids."""
    import tiktoken

    reached = {*encoder.first, *encoder.merged}
    own = {i: b for i, b in encoder.bytes_of.items() if i in reached}
    same = sorted(encoder.merged) == encoder.merged and len(set(own.values())) == len(own) and all(encoder.merge(b) == [i] for i, b in own.items())
    return tiktoken.Encoding("a", pat_str=PRETOKEN.pattern, mergeable_ranks={b: i for i, b in own.items()}, special_tokens={}) if same else None


def bounded(text: str) -> bool:
    """Whether no run without white space, and none of white space, is longer than ``RUN``."""
    words = list(map(len, text.split()))
    return max(words, default=0) < RUN and len(text) - sum(words) - len(words) < RUN


def default_piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def piece_bytes(piece: str) -> bytes:
    """The bytes of a piece: the space mark is a space, <0xHH> a byte."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes.fromhex(piece[3:5])
    return piece.replace(SPACE, " ").encode("utf-8")


_aligners: dict[tuple, Aligner] = {}


def aligner(path_a: str | None, path_b: str | None) -> Aligner:
    """The worker's aligner for two files, read once."""
    key = (path_a, path_b)
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(*key)
    return _aligners[key]


def aligned(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Documents (kind 0): doc_id, ids_a, ids_b, groups' text digest and numbers. Id pairs (kind 1): pair (a << 32 | b) and n, per task."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["kind", "doc_id", "ids_a", "ids_b", "n_groups", "n_links", "groups_sha256", "pair", "n"]
    schema = f"kind int, doc_id {kind}, ids_a array<int>, ids_b array<int>, n_groups long, n_links long, groups_sha256 string, pair long, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen, doc_type = aligner(path_a, path_b), Counter(), None
        for batch in slices(batches, BATCH):
            a, b = own.tokenise(strings(batch.column("text")))
            doc_type = batch.column("doc_id").type
            keys, first = own.windows(a.values, b.values)
            own.learn(set(keys))
            found = list(map(own.memo.__getitem__, keys))
            of_doc = np.searchsorted(first, a.ends).tolist()
            texts = [";".join(found[i:j]) for i, j in zip(of_doc, of_doc[1:])]
            digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]
            n_groups = own.groups(a, b)
            n_links = np.diff(a.ends) + np.diff(b.ends) - n_groups  # one begins where a token of either side does
            pair, n = np.unique(own.links(a.values, b.values), return_counts=True)
            for p, k in zip(pair.tolist(), n.tolist()):
                seen[p] += k
            size = batch.num_rows
            none = pa.nulls(size, pa.int64())
            yield pa.RecordBatch.from_arrays([
                pa.array([0] * size, pa.int32()), batch.column("doc_id"), a.column(), b.column(),
                pa.array(n_groups), pa.array(n_links), pa.array(digests, pa.string()), none, none], names)
            if len(seen) > FLUSH:
                yield pairs(seen, doc_type)
                seen.clear()
        if seen:
            yield pairs(seen, doc_type)

    def pairs(seen: Counter, doc_type: pa.DataType) -> pa.RecordBatch:
        size = len(seen)
        none = pa.nulls(size, pa.int64())
        ids = pa.nulls(size, pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([
            pa.array([1] * size, pa.int32()), pa.nulls(size, doc_type), ids, ids, none, none, pa.nulls(size, pa.string()), pa.array(list(seen), pa.int64()),
            pa.array(list(seen.values()), pa.int64())], names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def pair_counts(found: DataFrame) -> DataFrame:
    """pair, n (links of the corpus that hold it) and best (no pair of the same B id has more)."""
    counted = found.where("kind = 1").groupBy("pair").agg(F.sum("n").alias("n"))
    counted = saved(counted.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))), "pairs")
    most = counted.groupBy("b").agg(F.max("n").alias("most"))
    return saved(counted.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pairs")


class _Table:
    """Pair counts by binary search over packed pairs."""

    def __init__(self, sent: tuple[np.ndarray, np.ndarray, np.ndarray]):
        self.pair, self.n, self.best = sent

    def find(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each pair: whether it is here, its count and whether it is best (0 if it is not here)."""
        if not len(self.pair):
            return np.zeros(len(pairs), bool), np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
        at = np.minimum(np.searchsorted(self.pair, pairs), len(self.pair) - 1)
        here = self.pair[at] == pairs
        return here, np.where(here, self.n[at], 0), (here & self.best[at]).astype(np.int64)


def _frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """At most ``most`` pairs, sorted: all, or those of the largest counts."""
    levels = counts.groupBy(F.floor(F.log2("n")).cast("int").alias("level")).agg(F.count("*").alias("pairs")).orderBy(F.desc("level")).collect()
    total, least = 0, None
    for level in levels:  # one row for each power of two
        total += level.pairs
        if total > most:
            break
        least = level.level
    chosen = counts.where(F.floor(F.log2("n")) >= (least if least is not None else 1 << 20))
    table = chosen.toArrow().combine_chunks()
    pair = table.column("pair").to_numpy()
    order = np.argsort(pair)
    return tuple(np.ascontiguousarray(x[order]) for x in (pair, table.column("n").to_numpy(), table.column("best").to_numpy(zero_copy_only=False)))


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, most_pairs: int = PAIRS, ids: bool = True) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; with ``ids`` also ids_a and ids_b."""
    spark = docs.sparkSession
    with rows_per_batch(spark, BATCH):
        found = saved(aligned(docs, path_a, path_b), "aligned")
        counts = pair_counts(found)
        table = _frequent(counts, most_pairs)
        # The locator only joins back what is not handed through Python.
        documents = located(found).where("kind = 0").drop("pair", "n", "kind")
        summed = saved(_link_sums(documents, Sent(spark, table), path_a, path_b), "summed")
    if counts.count() > len(table[0]):
        rare = (
            summed.select(FILE, ROW, F.explode("missing").alias("m")).select(FILE, ROW, "m.pair", "m.times").join(counts, "pair")
            .groupBy(FILE, ROW).agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
        )
        summed = summed.join(rare, [FILE, ROW], "left").withColumns({
            "n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0)),
        })
    numbers = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if ids:
        return summed.join(documents.select(FILE, ROW, "ids_a", "ids_b"), [FILE, ROW]).select(*numbers, "ids_a", "ids_b")
    return summed.select(*numbers)


def _link_sums(documents: DataFrame, table: Sent, path_a: str | None, path_b: str | None) -> DataFrame:
    """Per document its numbers, n_best and count_sum of the links in the table; the others' pairs and how often the document holds them."""
    kept = ["doc_id", "n_groups", "n_links", "groups_sha256", FILE, ROW]
    pairs = pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counted = aligner(path_a, path_b), table.derive(_Table)
        own.forget()
        for batch in slices(batches, BATCH):
            a, b = (Ids.read(batch.column(name)) for name in ("ids_a", "ids_b"))
            links = own.links(a.values, b.values)
            doc = np.cumsum([0, *batch.column("n_links").to_pylist()])
            here, n, best = counted.find(links)
            total, n_best = (np.append(0, np.cumsum(x))[doc] for x in (n, best))
            missing = None
            if not here.all():
                missing = [[{"pair": p, "times": k} for p, k in Counter(links[i:j][~here[i:j]].tolist()).items()] for i, j in zip(doc, doc[1:])]
            missing = pa.array(missing, pairs) if missing else pa.nulls(batch.num_rows, pairs)
            yield pa.RecordBatch.from_arrays(
                [*batch.select(kept).columns, pa.array(np.diff(a.ends)), pa.array(np.diff(b.ends)), pa.array(np.diff(n_best)), pa.array(np.diff(total)), missing],
                [*kept, "n_a", "n_b", "n_best", "count_sum", "missing"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select(*kept, "ids_a", "ids_b").mapInArrow(
        run, f"doc_id {kind}, n_groups long, n_links long, groups_sha256 string, {FILE} string, {ROW} long, n_a long, n_b long, n_best long, "
        "count_sum long, missing array<struct<pair:long,times:long>>")
