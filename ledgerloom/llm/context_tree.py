"""LM scoring by context-tree weighting over binary-decomposed bytes.

A text is taken as its words in lower case (A-Z only), joined by single spaces and closed by
a newline, which stands for the end. Each byte is coded as eight binary decisions. A
decision has one node for every context depth 0..DEPTH (that many bytes before it); a node
holds how often the decision was 0 and 1 in training. Its Krichevsky-Trofimov estimate and
its children's weighted probabilities are mixed half and half, bottom up; the posterior
weights of stopping at a node then give the mixed prediction, top down. Of contexts that
never occurred in training only the seen part of the path takes part. The score is the log10
probability of all bytes, so -log2 / bytes is the code length per byte.

How it runs. One pass counts, within tasks, all strings of DEPTH + 1 bytes; all shallower
counts follow from them. The counts are sent as packed arrays and summed by their two latest
context bytes, so a row of the sums holds a whole subtree. Only the sums of the 65,280
possible nodes of depth 1 go to the driver, whatever the corpus. A second pass adds up the log
probabilities of the strings of each text: frequent strings from a broadcast table of at most
``GRAMS`` entries, the others are sent as packed arrays to their part of the table of all strings
(parts are even, by a hash); what they add is summed by text within tasks, then by a shuffle. The unigram base has at
most ``TOKENS`` broadcast words and takes a join for the others.

Defined results: null and empty texts consist of the end alone. Rows with the same doc_id are
scored one by one. Without training rows every decision has probability 1/2. An empty table
gives an empty result. Texts are never cut. Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import Sent, in_fold, rows_per_batch, saved

#: Bytes of context. The strings, one byte longer, are packed into 64-bit numbers.
DEPTH = 6
FOLDS, HELD_OUT = 7, 2
#: Entries of the broadcast tables, at most.
GRAMS, TOKENS = 1 << 20, 1 << 19
END = b"\n"
#: Bytes counted at once, strings held before they are summed up, strings whose trees are weighted at once.
_CHUNK, _HELD, _SUBTREES = 1 << 20, 1 << 21, 1 << 18
#: Rows of packed strings sent at once, so that their copies stay small.
_SENT = 1 << 10
#: Texts handed to Python at a time.
_BATCH = 1024
#: Texts scored at once: a text's number among them and a string make one 64-bit number.
_TEXTS = 256
#: Codec of the tables of strings, which are the largest.
_CODEC = "zstd"
#: Groups that words are shuffled in.
_BUCKETS = 1 << 14
#: Bytes of texts whose words are taken at once.
_WORDS = 1 << 22
#: Strings in a part of their table, roughly, and the parts' number as a power of two, from and to.
_PART, _PART_BITS = 1 << 16, (10, 16)
#: Missing strings sent in one row, so that batches of rows stay small.
_PACK = 1 << 9
#: Strings looked up at once, so that what is made on the way stays in the processor's cache.
_BLOCK = 1 << 16


def words_of(texts: pa.Array) -> tuple[list[bytes], pa.Array, np.ndarray]:
    """Binary texts (null: empty) as their words joined and closed, all words, and the words per text.

    At ASCII white space, A-Z in lower case only; the bytes need not be UTF-8.
    """
    plain = pc.ascii_trim_whitespace(pc.ascii_lower(texts.fill_null(b"").view(pa.string())))
    split = pc.ascii_split_whitespace(plain)
    lengths = pc.list_value_length(split).to_numpy().astype(np.int64)
    lengths[pc.binary_length(plain).to_numpy() == 0] = 0
    words = split.flatten().view(pa.binary())
    if len(words) > lengths.sum():  # a blank text gives one empty word
        words = words.filter(pc.greater(pc.binary_length(words), 0))
    return [t + END for t in pc.binary_join(split, " ").view(pa.binary()).to_pylist()], words, lengths


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, cut where their texts grow long."""
    for batch in batches:
        size = pc.binary_length(batch.column("text")).fill_null(0).to_numpy().cumsum(dtype=np.int64) // _WORDS
        cuts = [0, *(np.flatnonzero(size[1:] != size[:-1]) + 1).tolist(), len(size)]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def packed(joined: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """The strings of depth + 1 bytes that end at each byte of each text, and the bytes per text."""
    pad = END * depth
    lengths = np.array([len(j) for j in joined], dtype=np.int64)
    data = pad.join([b"", *joined]) + bytes(8)
    size = len(data) - 8 - depth
    if size <= 0:
        return np.zeros(0, np.int64), lengths
    # Eight bytes from each place as one number, cut to the first depth + 1.
    whole = np.ndarray(size, ">u8", data, 0, (1,)).astype(np.uint64)
    whole >>= np.uint64(8 * (7 - depth))
    grams = whole.view(np.int64)
    starts = np.cumsum(lengths + depth) - lengths - depth
    keep = np.ones(size, dtype=bool)
    for k in range(depth):  # strings that end in the next text's padding
        keep[starts[1:] - depth + k] = False
    return grams[keep], lengths


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of equal keys added up, sorted by key."""
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(len(key), 1), bool), key[1:] != key[:-1])))
    return key[first], np.add.reduceat(n, first) if len(first) else n


class _Strings:
    """Strings counted in a task; the lowest bit of a key tells training texts from others."""

    def __init__(self) -> None:
        self.keys: list[np.ndarray] = []
        self.numbers: list[np.ndarray] = []
        self.size = 0

    def add(self, texts: list[bytes], training: bool, depth: int) -> None:
        key = packed(texts, depth)[0]
        key <<= 1
        key |= int(training)
        key, n = np.unique(key, return_counts=True)
        self.keys.append(key)
        self.numbers.append(n.astype(np.int32))  # of one task
        self.size += len(key)
        if self.size > max(_HELD, 2 * len(self.keys[0])):  # twice what the last sum left
            self.sum_up()

    def sum_up(self) -> None:
        if len(self.keys) > 1:
            key, n = summed(self.keys, self.numbers)
            self.keys, self.numbers, self.size = [key], [n], len(key)


class _Words:
    """Words counted in a task; the end is kept as the empty word."""

    def __init__(self) -> None:
        self.words: list[pa.Array] = []
        self.numbers: list[np.ndarray] = []
        self.size = 0

    def add(self, words: pa.Array, texts: int) -> None:
        """The words of so many texts."""
        found = words.dictionary_encode()
        self.words += [found.dictionary, pa.array([b""], pa.binary())]
        self.numbers += [np.bincount(found.indices.to_numpy(), minlength=len(found.dictionary)), np.array([texts])]
        self.size += len(found.dictionary) + 1
        if self.size > max(_HELD, 2 * len(self.words[0])):
            self.sum_up()

    def sum_up(self) -> None:
        if len(self.words) > 1:
            found = pa.concat_arrays(self.words).dictionary_encode()
            n = np.bincount(found.indices.to_numpy(), weights=np.concatenate(self.numbers), minlength=len(found.dictionary))
            self.words, self.numbers, self.size = [found.dictionary], [n.astype(np.int64)], len(n)


_COUNTED = "kind int, key int, token binary, n long, grams binary, counts binary"


def _counted(kind: int, key, token, n, grams, numbers) -> pa.RecordBatch:
    size = len(key)
    null = lambda x, t: pa.nulls(size, t) if x is None else pa.array(x, t)
    return pa.RecordBatch.from_pydict({
        "kind": pa.array(np.full(size, kind, np.int32)), "key": pa.array(key, pa.int32()), "token": null(token, pa.binary()),
        "n": null(n, pa.int64()), "grams": null(grams, pa.binary()), "counts": null(numbers, pa.binary())})


def counts(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """kind 0: words (token) and n, their occurrences in training texts. kind 1: by the two latest
    context bytes (key) all strings (grams) with their occurrences in training texts (counts).

    Tasks send packed arrays by key, so the shuffle moves few rows and sums are vector operations.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        Sent.release()  # workers are reused: tables of an earlier run may be there
        tokens = _Words()
        strings = _Strings()

        def send() -> Iterator[pa.RecordBatch]:
            strings.sum_up()
            for key, n in zip(strings.keys, strings.numbers):
                latest = ((key >> 9) & 0xFFFF).astype(np.uint16)  # 16 bits are sorted by radix
                order = np.argsort(latest, kind="stable")
                key, n, latest = key[order], n[order], latest[order]
                cuts = [0, *(np.flatnonzero(latest[1:] != latest[:-1]) + 1).tolist(), len(key)]
                parts = [slice(a, b) for a, b in zip(cuts, cuts[1:])]
                for k in range(0, len(parts), _SENT):
                    some = parts[k : k + _SENT]
                    yield _counted(1, latest[cuts[k : k + len(some)]], None, None, [key[x].tobytes() for x in some], [n[x].astype(np.int32).tobytes() for x in some])
            tokens.sum_up()
            for words, n in zip(tokens.words, tokens.numbers):
                bucket = np.array([zlib.crc32(t) % _BUCKETS for t in words.to_pylist()], np.uint16)
                order = np.argsort(bucket, kind="stable")
                words, n, bucket = words.take(pa.array(order)), n[order], bucket[order]
                cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), words)
                yield _counted(0, bucket[cuts[:-1]], None, None, pc.binary_join(lists, END), [n[a:b].tobytes() for a, b in zip(cuts, cuts[1:])])
            strings.__init__()
            tokens.__init__()

        for batch in _bounded(batches):
            waiting: dict[bool, list] = {True: [], False: []}
            size = {True: 0, False: 0}
            joined, words, lengths = words_of(batch.column("text"))
            learns = np.array(batch.column("training").to_pylist(), bool)
            if learns.any():
                tokens.add(words.filter(pa.array(np.repeat(learns, lengths))), int(learns.sum()))
            for text, learn in zip(joined, learns.tolist()):
                waiting[learn].append(text)
                size[learn] += len(text)
                if size[learn] > _CHUNK:
                    strings.add(waiting[learn], learn, depth)
                    waiting[learn], size[learn] = [], 0
            for learn, texts in waiting.items():
                if texts:
                    strings.add(texts, learn, depth)
            if strings.size > 2 * _HELD or tokens.size > 2 * _HELD:
                yield from send()
        yield from send()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, bytes]] = []
        now: tuple[int, int] | None = None
        for batch in batches:
            columns = [batch.column(c) for c in ("kind", "key", "grams", "counts")]
            for kind, key, grams, numbers in zip(*columns):
                at = (kind.as_py(), key.as_py())
                if at != now and held:
                    yield _merged(*now, held)
                    held = []
                now = at
                held.append((grams.as_py(), numbers.as_py()))
        if held:
            yield _merged(*now, held)

    sent = docs.mapInArrow(count, _COUNTED)
    return saved(sent.repartition("kind", "key").sortWithinPartitions("kind", "key").mapInArrow(merge, _COUNTED), "counts", _CODEC)


def _merged(kind: int, key: int, held: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    """The sum of what the tasks sent for one key."""
    if kind == 0:
        total: Counter = Counter()
        for words, numbers in held:
            for token, n in zip(words.split(b"\n"), np.frombuffer(numbers, np.int64).tolist()):
                total[token or END] += n
        return _counted(0, [key] * len(total), list(total), list(total.values()), None, None)
    keys, n = summed([np.frombuffer(k, np.int64) for k, _ in held], [np.frombuffer(c, np.int32).astype(np.int64) for _, c in held])
    n = n * (keys & 1)  # other texts' strings are scored too, but not learnt from
    grams, n = summed([keys >> 1], [n])
    return _counted(1, [key], None, None, [grams.tobytes()], [n.tobytes()])


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural log of the gamma function for x > 0, by Stirling's series at x + 8."""
    shift = np.ones_like(x)
    for k in range(8):
        shift = shift * (x + k)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(shift)


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log probability that the estimator gives to n0 zeros and n1 ones."""
    big = np.float64
    n0, n1 = n0.astype(big), n1.astype(big)
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1) - math.log(math.pi)


class Level:
    """Nodes of one depth, sorted by (decision, latest byte, ... , oldest byte)."""

    def __init__(self, key: np.ndarray, n0: np.ndarray, n1: np.ndarray, below: np.ndarray | None):
        """``below``: sum of the children's weighted log probabilities; None at the deepest level."""
        self.key, self.n0, self.n1 = key, n0, n1
        kt = log_kt(n0, n1)
        half = math.log(0.5)
        self.weighted = kt if below is None else np.logaddexp(half + kt, half + below)
        self.stop = np.ones(len(key)) if below is None else np.exp(half + kt - self.weighted)
        self.one = (n1 + 0.5) / (n0 + n1 + 1.0)
        self.parent: np.ndarray | None = None  # of each node, in the level above

    def above(self) -> "Level":
        """The level one byte shallower."""
        key = self.key >> 8
        first = np.flatnonzero(np.concatenate((np.ones(min(len(key), 1), bool), key[1:] != key[:-1])))
        self.parent = np.cumsum(np.concatenate((np.zeros(min(len(key), 1), np.int64), (key[1:] != key[:-1]).astype(np.int64))))
        total = lambda x: np.add.reduceat(x, first) if len(first) else x
        return Level(key[first], total(self.n0), total(self.n1), total(self.weighted))


def decisions(grams: np.ndarray, n: np.ndarray, depth: int = DEPTH) -> tuple[Level, np.ndarray]:
    """The deepest level of the strings' nodes, and for each string its eight nodes there."""
    byte = grams & 0xFF
    context = np.zeros(len(grams), np.int64)
    for k in range(1, depth + 1):  # latest byte on top
        context = (context << 8) | ((grams >> (8 * k)) & 0xFF)
    # Sorted once by context and byte: a node's strings stand together for each of the eight decisions.
    order = np.argsort((context << 8) | byte)
    byte, context, n = byte[order], context[order], n[order]
    other = np.concatenate((np.ones(min(len(n), 1), bool), context[1:] != context[:-1]))
    at, keys, zeros, ones, size = np.zeros((8, len(n)), np.int64), [], [], [], 0
    for i in range(8):
        code = (1 << i) | (byte >> (8 - i))
        starts = other.copy()
        starts[1:] |= code[1:] != code[:-1]
        first = np.flatnonzero(starts)
        total = lambda x: np.add.reduceat(x, first) if len(first) else x
        place = np.argsort(code[first].astype(np.uint8), kind="stable")  # of nodes sorted by context
        n1 = total(n * ((byte >> (7 - i)) & 1))[place]
        keys.append(((code[first] << (8 * depth)) | context[first])[place])
        ones.append(n1)
        zeros.append(total(n)[place] - n1)
        rank = np.empty(len(first), np.int64)
        rank[place] = np.arange(size, size + len(first))
        at[i, order] = rank[np.cumsum(starts) - 1]
        size += len(first)
    n0, n1 = np.concatenate(zeros).astype(np.float64), np.concatenate(ones).astype(np.float64)
    return Level(np.concatenate(keys), n0, n1, None), at


def subtree(grams: np.ndarray, n: np.ndarray, depth: int, top: int) -> tuple[list[Level], np.ndarray]:
    """Levels from the deepest to ``top``."""
    level, at = decisions(grams, n, depth)
    levels = [level]
    for _ in range(depth - top):
        levels.append(levels[-1].above())
    return levels, at


def shallow(rows: list[tuple[int, float, float, float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By node of depth 1 (decision, byte): what depths 0 and 1 add to the chance of a 1, the weight
    left for deeper nodes, and the chance of a 1 if no deeper node was seen.

    ``rows``: key, zeros, ones, children's weighted log probability of the nodes of depth 1.
    """
    add, left, end = np.zeros(1 << 16), np.ones(1 << 16), np.full(1 << 16, 0.5)
    if rows:
        key, n0, n1, below = (np.array(x) for x in zip(*sorted(rows)))
        one = Level(key.astype(np.int64), n0, n1, below)
        root = one.above()
        stop = np.where(n0 + n1 > 0, root.stop[one.parent], 1.0)
        first = stop * root.one[one.parent]
        add[one.key] = first + (1 - stop) * one.stop * one.one
        left[one.key] = (1 - stop) * (1 - one.stop)
        end[one.key] = first + (1 - stop) * one.one
    return add, left, end


def predicted(levels: list[Level], at: np.ndarray, grams: np.ndarray, top: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """log10 probability of each string's last byte; ``levels``: from the deepest to depth 2."""
    add, rest, end = top
    down = levels[::-1]  # depth 2 first
    total = np.zeros(len(grams))
    byte = grams & 0xFF
    for i in range(8):
        node = [at[i]]
        for level in levels[:-1]:
            node.append(level.parent[node[-1]])
        node = node[::-1]
        one = down[0].key[node[0]] >> 8  # the node of depth 1
        seen = [(x.n0 + x.n1)[k] > 0 for x, k in zip(down, node)]
        chance = np.where(seen[0], add[one], end[one])
        left = np.where(seen[0], rest[one], 0.0)
        for d, (level, k) in enumerate(zip(down, node)):
            stop = level.stop[k]
            if d + 1 < len(down):
                stop = np.where(seen[d + 1], stop, 1.0)
            chance += left * stop * level.one[k]
            left *= 1 - stop
        bit = (byte >> (7 - i)) & 1
        total += np.log10(np.where(bit == 1, chance, 1 - chance))
    return total


def _subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Strings and counts of whole keys, so many at once as make good arrays."""
    grams, numbers, size = [], [], 0
    for batch in batches:
        for g, n in zip(batch.column("grams"), batch.column("counts")):
            grams.append(np.frombuffer(g.as_py(), np.int64))
            numbers.append(np.frombuffer(n.as_py(), np.int64))
            size += len(grams[-1])
            if size > _SUBTREES:
                yield np.concatenate(grams), np.concatenate(numbers)
                grams, numbers, size = [], [], 0
    if grams:
        yield np.concatenate(grams), np.concatenate(numbers)


def gram_scores(counted: DataFrame, depth: int = DEPTH) -> DataFrame:
    """gram, n and logp: log10 of the mixed probability of the string's last byte after the others."""
    trees = counted.where("kind = 1").select("grams", "counts")

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gram, n in _subtrees(batches):
            two = subtree(gram, n, depth, 2)[0][-1]
            key, at = np.unique(two.key >> 8, return_inverse=True)
            total = lambda x: np.bincount(at, weights=x, minlength=len(key))
            yield pa.RecordBatch.from_pydict({"key": key, "n0": total(two.n0), "n1": total(two.n1), "below": total(two.weighted)})

    ones = trees.mapInArrow(sums, "key long, n0 double, n1 double, below double").groupBy("key").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("below").alias("below"))
    top = Sent(counted.sparkSession, shallow([tuple(r) for r in ones.collect()]))  # at most 255 x 256 rows

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for gram, n in _subtrees(batches):
            levels, at = subtree(gram, n, depth, 2)
            yield pa.RecordBatch.from_pydict({"gram": gram, "n": n, "logp": predicted(levels, at, gram, top.value.value)})

    return saved(trees.mapInArrow(score, "gram long, n long, logp double"), "strings", _CODEC)


class Lookup:
    """A hash table of strings and log probabilities in flat arrays."""

    def __init__(self, sent: tuple[np.ndarray, np.ndarray]):
        keys, values = sent
        self.bits = max(4, int(2 * max(len(keys), 1) - 1).bit_length())  # at most half full
        self.keys = np.full(2 << self.bits, -1, np.int64)  # a key and its value side by side
        self.values = self.keys.view(np.float64)
        slot = self._slot(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[2 * slot] < 0)
            taken, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[2 * taken], self.values[2 * taken + 1] = keys[put], values[put]
            rest = np.ones(len(keys), bool)
            rest[put] = False
            keys, values, slot = keys[rest], values[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, and the positions of keys that aren't there (with value 0)."""
        values, absent = np.empty(len(keys)), [np.zeros(0, np.int64)]
        for at in range(0, len(keys), _BLOCK):
            some = keys[at : at + _BLOCK]
            slot = self._slot(some)
            held = self.keys.take(2 * slot, mode="clip")
            self.values.take(2 * slot + 1, mode="clip", out=values[at : at + _BLOCK])
            rest = np.flatnonzero(held != some)
            held, slot, wanted = held[rest], slot[rest], some[rest]
            while len(rest):
                gone, same = held < 0, held == wanted
                values[at + rest[gone]] = 0.0
                absent.append(at + rest[gone])
                values[at + rest[same]] = self.values[2 * slot[same] + 1]
                on = ~(gone | same)
                rest, wanted = rest[on], wanted[on]
                slot = (slot[on] + 1) & ((1 << self.bits) - 1)
                held = self.keys[2 * slot]
        return values, np.concatenate(absent)


def frequent(table: DataFrame, most: int) -> DataFrame:
    """The rows with the largest n: as many whole classes of n (by its bit length) as hold at most ``most`` rows."""
    size = F.ceil(F.log2(F.col("n") + 1.0)).cast("int")
    total, least = 0, None
    for r in sorted(table.where("n > 0").groupBy(size.alias("size")).count().collect(), reverse=True):  # at most 63 rows
        total += r["count"]
        if total > most:
            break
        least = r["size"]
    return table.where(F.lit(False)) if least is None else table.where((size >= least) & (F.col("n") > 0))


_OUT = ("row long, kind int, doc_id long, n_tokens long, n_known long, base double, score double, token binary, n long, "
        "part int, grams binary, texts binary, numbers binary")
_SENDS = "row long, kind int, part int, grams binary, texts binary, numbers binary"


def score_texts(docs: DataFrame, training: Column | None = None, depth: int = DEPTH, grams: int = GRAMS, tokens: int = TOKENS) -> DataFrame:
    """Per row: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    ``training``: which rows are learnt from; default: those outside the held-out fold.
    """
    spark = docs.sparkSession
    if not 1 < depth <= 6:
        raise ValueError("strings of depth + 1 bytes must fit into 64 bits, with at least two bytes of context")
    learnt = ~in_fold(F.col("doc_id"), FOLDS, HELD_OUT) if training is None else training
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"), learnt.alias("training"))
    with rows_per_batch(spark, _BATCH):
        counted = counts(rows.select("text", "training"), depth)
    words = counted.where("kind = 0").select("token", "n")
    strings = gram_scores(counted, depth)
    n_train, n_types = words.where("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    unit = math.log10(n_train + n_types + 1)

    top = frequent(strings, grams).select("gram", "logp").toArrow()
    table = Sent(spark, (top.column("gram").to_numpy(), top.column("logp").to_numpy()))
    common = frequent(words, tokens).select("token", "n").toArrow()
    known = Sent(spark, (common.column("token").combine_chunks(), common.column("n").to_numpy()))
    bits = min(max((strings.count() // _PART).bit_length(), _PART_BITS[0]), _PART_BITS[1])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, log_count, missing = table.derive(Lookup), known.derive(_LogCounts), _Missing(bits)
        for batch in _bounded(batches):
            yield from _scored(batch, lookup, log_count, missing, unit, depth)
            if missing.size > _HELD:
                yield from missing.sent()
        yield from missing.sent()

    with rows_per_batch(spark, _BATCH):
        kept = saved(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(score, _OUT), "scored", _CODEC)
    of_token = kept.where("kind = 1").select("row", "token", F.col("n").alias("times")).join(words.where("n > 0"), "token")
    parts = (
        kept.where("kind = 0").select("row", "doc_id", "n_tokens", "n_known", "base", "score")
        .unionByName(of_token.select("row", F.col("times").alias("n_known"), (F.col("times") * F.log10(F.col("n") + 1.0)).alias("base")), allowMissingColumns=True)
        .unionByName(_rest(kept, strings, bits), allowMissingColumns=True))
    return parts.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"),
        F.sum("base").alias("base_score"), F.sum("score").alias("score"),
    ).select("doc_id", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score")


class _LogCounts:
    """Known words and the logs of their counts."""

    def __init__(self, sent: tuple[pa.Array, np.ndarray]):
        self.words, n = sent
        self.logs = np.append(np.log10(n + 1.0), np.nan)  # the last one: of words that aren't there
        self.end = float(self.find(pa.array([END], pa.binary()))[0])

    def find(self, words: pa.Array) -> np.ndarray:
        """Not a number for words that aren't there."""
        return self.logs[pc.index_in(words, value_set=self.words).fill_null(len(self.logs) - 1).to_numpy()]


def _part_of(grams: np.ndarray, bits: int) -> np.ndarray:
    return ((grams.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)).astype(np.uint16)


def _by_part(bits: int, grams: np.ndarray, *others: np.ndarray) -> Iterator[tuple[list[int], list[list[bytes]]]]:
    """Packed arrays, at most so many entries in each: parts, and the slices of each array."""
    part = _part_of(grams, bits)
    order = np.argsort(part, kind="stable")
    part = part[order]
    cuts = np.unique(np.concatenate((np.flatnonzero(part[1:] != part[:-1]) + 1, np.arange(0, len(part) + 1, _PACK), [len(part)]))).tolist()
    sorted_ = [x[order] for x in (grams, *others)]
    for k in range(0, len(cuts) - 1, _SENT):
        some = cuts[k : k + _SENT + 1]
        yield part[some[:-1]].tolist(), [[x[a:b].tobytes() for a, b in zip(some, some[1:])] for x in sorted_]


class _Missing:
    """Strings of a task's texts that the broadcast table lacks: string, row and how often."""

    def __init__(self, bits: int):
        self.bits, self.size = bits, 0
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, grams: np.ndarray, rows: np.ndarray, times: np.ndarray) -> None:
        self.held.append((grams, rows, times.astype(np.uint32)))
        self.size += len(grams)

    def sent(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            grams, rows, times = (np.concatenate(x) for x in zip(*self.held))
            self.__init__(self.bits)
            first = int(rows.min())
            for part, (g, texts, numbers) in _by_part(self.bits, grams, (rows - first).astype(np.uint32), times):  # ids of one task
                yield _rows(len(part), {"row": first, "kind": 2, "part": part, "grams": g, "texts": texts, "numbers": numbers})


def _rest(kept: DataFrame, strings: DataFrame, bits: int) -> DataFrame:
    """row and score: what the strings add that texts sent to their parts, a row per text and string."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in _gathered(batches):
            for part, (g, logp) in _by_part(bits, some.column("gram").to_numpy(), some.column("logp").to_numpy()):
                yield _rows(len(part), {"kind": 0, "part": part, "grams": g, "numbers": logp}, _PARTS)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now = _Part(), None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("part", "kind", "row", "grams", "texts", "numbers")]
            for number, kind, row, g, texts, numbers in zip(*columns):
                if number != now:
                    yield from part.found()
                    part, now = _Part(), number
                if kind == 0:  # before all of kind 2
                    part.table.append((np.frombuffer(g, np.int64), np.frombuffer(numbers, np.float64)))
                else:
                    part.wanted.append((np.frombuffer(g, np.int64), row + np.frombuffer(texts, np.uint32).astype(np.int64), np.frombuffer(numbers, np.uint32)))
            yield from part.found()

    both = strings.select("gram", "logp").mapInArrow(send, _SENDS).unionByName(kept.where("kind = 2").select(*_PARTS.names))
    return both.repartition("part").sortWithinPartitions("part", "kind").mapInArrow(join, "row long, score double")


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of many rows."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size > _HELD:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


class _Part:
    """A part of the table of strings, and what texts want of it."""

    def __init__(self) -> None:
        self.table: list[tuple[np.ndarray, np.ndarray]] = []
        self.sorted: tuple[np.ndarray, np.ndarray] | None = None
        self.wanted: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def found(self) -> Iterator[pa.RecordBatch]:
        if self.wanted:
            if self.sorted is None:
                keys, logp = (np.concatenate(x) for x in zip(*self.table))
                order = np.argsort(keys)
                self.table, self.sorted = [], (keys[order], logp[order])
            grams, rows, times = (np.concatenate(x) for x in zip(*self.wanted))
            self.wanted = []
            at = np.searchsorted(self.sorted[0], grams)  # all strings of all texts are there
            yield pa.RecordBatch.from_pydict({"row": rows, "score": self.sorted[1][at] * times})


def _scored(batch: pa.RecordBatch, lookup: Lookup, log_count: _LogCounts, missing: _Missing, unit: float, depth: int) -> Iterator[pa.RecordBatch]:
    """A row per text (kind 0), and one per text and missing word (1); missing strings are held."""
    joined, words, n_words = words_of(batch.column("text"))
    ids = batch.column("row").to_numpy()
    found = words.dictionary_encode()
    index = found.indices.to_numpy()
    logs = log_count.find(found.dictionary)[index]
    absent = np.isnan(logs)
    ends = np.cumsum(n_words)
    n_known = n_words - np.bincount(np.repeat(np.arange(len(ids)), n_words)[absent], minlength=len(ids))
    plain = np.where(absent, 0.0, logs).tolist()
    end = log_count.end
    base = [math.fsum([*plain[a:b], 0.0 if math.isnan(end) else end]) - (b - a + 1) * unit for a, b in zip((ends - n_words).tolist(), ends.tolist())]
    score = np.zeros(len(ids))
    for at in range(0, len(ids), _TEXTS):  # bounds the arrays
        grams, lengths = packed(joined[at : at + _TEXTS], depth)
        logp, gone = lookup.find(grams)
        score[at : at + _TEXTS] = np.add.reduceat(logp, np.cumsum(lengths) - lengths)
        if len(gone):
            owner = np.repeat(np.arange(len(lengths), dtype=np.uint64), lengths)[gone]
            pair, n = np.unique(owner << np.uint64(56) | grams[gone].view(np.uint64), return_counts=True)
            gram = (pair & np.uint64((1 << 56) - 1)).view(np.int64)
            missing.add(gram, ids[at + (pair >> np.uint64(56)).astype(np.int64)], n)
    yield _rows(len(ids), {"row": ids, "kind": 0, "doc_id": batch.column("doc_id"), "n_tokens": n_words + 1,
                           "n_known": n_known + (not math.isnan(end)), "base": base, "score": score})
    if absent.any():
        owner = np.repeat(np.arange(len(ids)), n_words)[absent]
        pair, n = np.unique(owner * len(found.dictionary) + index[absent], return_counts=True)
        owner, word = np.divmod(pair, len(found.dictionary))
        yield _rows(len(pair), {"row": ids[owner], "kind": 1, "token": found.dictionary.take(pa.array(word)), "n": n})
    if math.isnan(end):
        yield _rows(len(ids), {"row": ids, "kind": 1, "token": [END] * len(ids), "n": np.ones(len(ids), np.int64)})


def _schema(columns: str) -> pa.Schema:
    types = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    return pa.schema([(name, types[kind]) for name, kind in (x.split() for x in columns.split(", "))])


_ARROW, _PARTS = _schema(_OUT), _schema(_SENDS)


def _rows(size: int, values: dict, schema: pa.Schema = _ARROW) -> pa.RecordBatch:
    """Rows of these columns; a plain number stands in all rows, other columns are null."""

    def column(field: pa.Field) -> pa.Array:
        x = values.get(field.name)
        if x is None:
            return pa.nulls(size, field.type)
        return pa.array(np.full(size, x) if isinstance(x, int) else x, field.type)

    return pa.RecordBatch.from_arrays([column(f) for f in schema], schema=schema)
