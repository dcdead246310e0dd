"""Source divergence audit: minimal-perfect-hash recount of the terms of each language.

A term is a run of letters A-Z (in lower case) and characters beyond ASCII. Each language keeps the
terms that at least ``MIN_DOCS`` of its documents hold. A group (language and source) and a
language as a whole give each kept term p = 1 + floor(10^9 (count + 1) / (N + V)): count its
occurrences there, N the sum of those counts, V the kept terms. A group differs from q, the p
of another group or of the language, by floor((p - q)^2 / q); all arithmetic is on integers.

How it runs. The first pass counts documents by term, within tasks first, and keeps the terms by
an exact filter. Kept terms are dealt into shards of at most about ``CELLS`` cells (terms x sources of the
language), and each gets a minimal perfect hash: levels of bit arrays in which every term that
has a bit of its own is placed, the others go one level down; a term's slot is the rank of its bit.
The hashes and the terms in order of slots are broadcast, at most ``BROADCAST`` bytes of them;
beyond that only those of the most frequent terms. The second pass looks terms up, compares them
with the stored ones, and adds to a dense array of slots per group, of which what isn't zero is held;
terms that were not broadcast are counted by a join with the other kept terms. A task sends one row
for each shard, with the (group, slot, count) of all groups; rows are summed in a tree of ``FAN`` rows a step, so
no task meets the rows of all tasks. The groups of a shard are then compared on their own:
whole terms are split by hash, so no term, source or language is a task of its own.

Defined results: null text, lang and source are empty ones; a group without terms, or of a
language that keeps none, takes part with counts of 0 and, if there are no terms, values of 0. A
language of one source has no pairs. Ties are ranked by the item's UTF-8. Repeated rows count
as several documents. An empty table gives an empty result. Other columns are not read; doc_id
is not, either. A language of 2^46 occurrences of kept terms or more is an error.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.bpe import slices
from ledgerloom.llm.common import Sent, rows_per_batch, saved

MIN_DOCS, TOP = 3, 200
SCALE = 1_000_000_000
#: Cells (terms x sources) of a shard, and the most terms of one.
CELLS, SHARD_TERMS = 1 << 20, 4096
#: Bytes of broadcast terms and hashes; (group, slot) pairs, and terms, that a task holds before it sends them on.
BROADCAST, HELD, FLUSH = 48 << 20, 4_000_000, 300_000
#: Rows of a shard that one step of the tree of sums takes together, and shards handed to Python at a time.
FAN, SHARDS = 64, 16
_MOST = 1 << 46

#: Letters in lower case and bytes beyond ASCII as they are, all else a space.
_TERMS = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TERMS).split()


def hashed(words: list[bytes]) -> np.ndarray:
    return np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)


def shard_of(words: list[bytes], shards: int) -> np.ndarray:
    """As Spark's pmod(xxhash64(term), shards) has it; independent of ``hashed``."""
    return np.mod(np.array([xxhash.xxh64_intdigest(w, 42) for w in words], np.uint64).view(np.int64), shards)


def _mixed(h: np.ndarray, level: np.ndarray | int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = h + np.asarray(level + 1, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Many minimal perfect hashes, one per shard, in common arrays; each maps its n terms onto 0..n-1.

    ``words`` holds the bits of all levels, ``ranks`` the bits set before each word within the
    shard, ``first`` and ``size`` where a level of a shard begins (in bits) and how many it has.
    """

    LEVELS = 48

    def __init__(self, words: np.ndarray, ranks: np.ndarray, first: np.ndarray, size: np.ndarray):
        self.words, self.ranks, self.first, self.size = words, ranks, first, size

    @staticmethod
    def build(h: np.ndarray) -> PerfectHash:
        """Of one shard. Equal hash values find no place; they raise."""
        left, words, first, size = h, [], [], []
        for level in range(PerfectHash.LEVELS):
            if not len(left):
                break
            bits = max(64, 64 * -(-len(left) * 5 // 4 // 64))
            at = (_mixed(left, level) % np.uint64(bits)).astype(np.int64)
            alone = np.bincount(at, minlength=bits) == 1
            first.append(64 * sum(map(len, words)))
            size.append(bits)
            words.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at]]
        if len(left):
            raise ValueError("terms with equal hash values")
        words = np.concatenate([*words, np.zeros(0, "<u8")])
        ranks = np.cumsum(np.append(0, np.bitwise_count(words).astype(np.int64)))[:-1]
        return PerfectHash(words, ranks, np.array([first]), np.array([size]))

    @staticmethod
    def joined(parts: list[PerfectHash]) -> PerfectHash:
        offsets = np.cumsum([0, *(64 * len(p.words) for p in parts)])
        most = max((p.first.shape[1] for p in parts), default=0)
        wide = lambda x, fill: np.pad(x, ((0, 0), (0, most - x.shape[1])), constant_values=fill)
        return PerfectHash(
            np.concatenate([*(p.words for p in parts), np.zeros(0, "<u8")]), np.concatenate([*(p.ranks for p in parts), np.zeros(0, np.int64)]),
            np.concatenate([wide(p.first + o, 0) for p, o in zip(parts, offsets)]) if parts else np.zeros((0, 0), np.int64),
            np.concatenate([wide(p.size, 0) for p in parts]) if parts else np.zeros((0, 0), np.int64))

    def slots(self, h: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """Slot of each hash value in its shard, -1 where no bit stands for it. Others than the shard's terms may get slots, too."""
        out = np.full(len(h), -1, np.int64)
        left = np.arange(len(h))
        for level in range(self.first.shape[1]):
            bits = self.size[shard[left], level]
            left = left[bits > 0]
            if not len(left):
                break
            at = self.first[shard[left], level] + (_mixed(h[left], level) % bits[bits > 0].astype(np.uint64)).astype(np.int64)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            found = (self.words[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[left[found]] = (self.ranks[word] + below)[found]
            left = left[~found]
        return out


class Lookup:
    """The broadcast shards: slots of terms, checked against the stored terms."""

    def __init__(self, rows: list[dict]):
        by_shard = {(r["lang"], r["shard"]): r for r in rows}
        rows = [by_shard.get((lang, i)) or _EMPTY | {"lang": lang, "shards": n} for lang, n in sorted({(r["lang"], r["shards"]) for r in rows}) for i in range(n)]
        self.hash = PerfectHash.joined([_unpacked(r) for r in rows])
        sizes = [r["size"] for r in rows]
        self.offset = np.cumsum([0, *sizes])
        self.terms = pa.concat_arrays([_term_array(r) for r in rows]) if rows else pa.array([], pa.large_binary())
        #: By language: its first shard here, how many the language has, and its slots.
        self.langs: dict[str, tuple[int, int, int]] = {}
        for i, r in enumerate(rows):
            first, _, slots = self.langs.get(r["lang"], (i, 0, 0))
            self.langs[r["lang"]] = (first, r["shards"], slots + r["size"])

    def slots(self, lang: str, words: list[bytes]) -> np.ndarray:
        """Slots within the language (shard by shard), -1 for terms that are not here."""
        if lang not in self.langs or not words:
            return np.full(len(words), -1, np.int64)
        first, shards, _ = self.langs[lang]
        shard = first + shard_of(words, shards)
        slot = self.hash.slots(hashed(words), shard)
        at = self.offset[shard] + slot
        known = np.flatnonzero(slot >= 0)
        same = pc.equal(self.terms.take(pa.array(at[known])), pa.array([words[i] for i in known.tolist()], pa.large_binary()))
        out = np.full(len(words), -1, np.int64)
        right = known[same.to_numpy(zero_copy_only=False).astype(bool)]
        out[right] = at[right] - self.offset[first]
        return out

    def shards(self, lang: str) -> np.ndarray:
        """Where the language's shards begin among its slots, and the end."""
        first, shards, _ = self.langs[lang]
        return self.offset[first : first + shards + 1] - self.offset[first]


#: A shard without terms.
_EMPTY = {"size": 0, "words": b"", "ranks": b"", "levels": b"", "ends": bytes(8), "terms": b""}


def _term_array(row: dict) -> pa.Array:
    return pa.Array.from_buffers(pa.large_binary(), row["size"], [None, pa.py_buffer(row["ends"]), pa.py_buffer(row["terms"])])


def _unpacked(row: dict) -> PerfectHash:
    levels = np.frombuffer(row["levels"], np.int64).reshape(2, 1, -1)
    return PerfectHash(np.frombuffer(row["words"], "<u8"), np.frombuffer(row["ranks"], np.int64), levels[0], levels[1])


def document_frequencies(docs: DataFrame) -> DataFrame:
    """lang, term and the number of the language's documents that hold it."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        for batch in slices(batches, 100):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                seen.setdefault(lang, Counter()).update(set(terms(text)))
            if sum(map(len, seen.values())) > FLUSH:
                yield from _counted(seen)
                seen.clear()
        yield from _counted(seen)

    def _counted(seen: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
        for lang, counter in seen.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(counter), pa.string()), pa.array([t.decode("utf-8", "surrogatepass") for t in counter], pa.string()),
                 pa.array(counter.values(), pa.int64())], ["lang", "term", "docs"])

    return docs.select("lang", "text").mapInArrow(count, "lang string, term string, docs long").groupBy("lang", "term").agg(F.sum("docs").alias("docs"))


def kept_terms(docs: DataFrame, groups: DataFrame, min_docs: int, broadcast: int) -> DataFrame:
    """lang, term, hot (whether it belongs to the broadcast tier), shards (of its language and tier), shard, numbered by tier."""
    kept = saved(document_frequencies(docs).where(F.col("docs") >= min_docs), "terms")
    # Of each power of two of document frequency: bytes of its terms, with about 8 of offsets and hash.
    level = F.floor(F.log2("docs")).cast("int")
    least, total = 1 << 30, 0
    for row in kept.groupBy(level.alias("level")).agg(F.sum(F.octet_length("term") + 16).alias("bytes")).orderBy(F.desc("level")).collect():
        total += row.bytes
        if total > broadcast:
            break
        least = row.level
    tiered = kept.withColumn("hot", level >= least)
    sources = groups.groupBy("lang").agg(F.count("*").alias("sources"))
    sizes = tiered.groupBy("lang", "hot").agg(F.count("*").alias("n")).join(sources, "lang")
    size = F.greatest(F.lit(64), F.least(F.lit(SHARD_TERMS), F.floor(F.lit(CELLS) / F.col("sources"))))
    # Half full on average, so that few shards exceed the size.
    sizes = saved(sizes.select("lang", "hot", F.ceil(2 * F.col("n") / size).cast("int").alias("shards")), "sizes")
    return tiered.join(sizes, ["lang", "hot"]).withColumn("shard", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int"))


_SHARD = "lang string, hot boolean, shard int, shards int, size int, words binary, ranks binary, levels binary, ends binary, terms binary"


def perfect_hashes(kept: DataFrame) -> DataFrame:
    """One row per shard: its perfect hash and its terms in order of their slots."""
    def build(rows: pa.Table) -> pa.Table:
        words = [t.encode("utf-8", "surrogatepass") for t in rows.column("term").to_pylist()]
        if len(words) > 1 << 16:
            raise ValueError("more terms in a shard than a slot number holds")
        h = hashed(words)
        found = PerfectHash.build(h)
        order = np.argsort(found.slots(h, np.zeros(len(h), np.int64)))
        words = [words[i] for i in order.tolist()]
        one = {name: rows.column(name)[0].as_py() for name in ("lang", "hot", "shard", "shards")}
        return pa.Table.from_pylist([one | {
            "size": len(words), "words": found.words.tobytes(), "ranks": found.ranks.tobytes(),
            "levels": np.stack([found.first, found.size]).astype(np.int64).tobytes(),
            "ends": np.cumsum([0, *map(len, words)]).astype(np.int64).tobytes(), "terms": b"".join(words)}], schema=schema)

    schema = pa.schema([
        ("lang", pa.string()), ("hot", pa.bool_()), ("shard", pa.int32()), ("shards", pa.int32()), ("size", pa.int32()),
        *((x, pa.binary()) for x in ("words", "ranks", "levels", "ends", "terms"))])
    return kept.select("lang", "hot", "shard", "shards", "term").groupBy("lang", "hot", "shard").applyInArrow(build, _SHARD)


#: Counts of one shard: the names of groups' sources, and per pair the place of its source, its slot and its count.
_PACKED = "sources array<string>, places binary, slots binary, counts binary, totals array<long>"


def packed(sources: list[str], places: np.ndarray, slots: np.ndarray, counts: np.ndarray) -> dict:
    totals = np.zeros(len(sources), np.int64)
    np.add.at(totals, places, counts)
    return {
        "sources": sources, "places": places.astype("<u4").tobytes(), "slots": slots.astype("<u2").tobytes(),
        "counts": counts.astype("<i8").tobytes(), "totals": totals.tolist()}


def matrix(rows: list[dict], sources: list[str], size: int) -> np.ndarray:
    """The sum of packed rows: a line per source, a column per slot."""
    line = {s: i for i, s in enumerate(sources)}
    total = np.zeros((len(sources), size), np.int64)
    for row in rows:
        own = np.array([line[s] for s in row["sources"]], np.int64)
        total[own[np.frombuffer(row["places"], "<u4")], np.frombuffer(row["slots"], "<u2")] += np.frombuffer(row["counts"], "<i8")
    return total


class _Held:
    """Counts of one task: per group, arrays of slots that occurred and how often."""

    def __init__(self, lookup: Lookup):
        self.lookup, self.groups, self.pairs, self.compact = lookup, {}, 0, 0

    def add(self, lang: str, source: str, slots: np.ndarray, counts: np.ndarray) -> None:
        if len(slots):
            self.groups.setdefault((lang, source), []).append((slots.astype(np.int32), counts))
            self.pairs += len(slots)
        if self.pairs > max(HELD, 2 * self.compact):
            self.sum_up()

    def sum_up(self) -> None:
        """One dense array of slots after the other takes in what its group has."""
        for group, parts in self.groups.items():
            if len(parts) > 1:
                dense = np.zeros(self.lookup.langs[group[0]][2], np.int64)
                for slots, counts in parts:
                    dense[slots] += counts
                slots = np.flatnonzero(dense)
                self.groups[group] = [(slots.astype(np.int32), dense[slots])]
        self.pairs = self.compact = sum(len(x[0]) for parts in self.groups.values() for x in parts)

    def full(self) -> bool:
        return self.compact > HELD

    def rows(self) -> Iterator[dict]:
        """One packed row for each shard that has counts."""
        self.sum_up()
        by_lang: dict[str, list] = {}
        for (lang, source), ((slots, counts),) in self.groups.items():
            by_lang.setdefault(lang, []).append((source, slots, counts))
        for lang, own in by_lang.items():
            slots, counts = (np.concatenate([x[k] for x in own]) for k in (1, 2))
            places = np.repeat(np.arange(len(own)), [len(x[1]) for x in own])
            begins = self.lookup.shards(lang)
            shard = np.searchsorted(begins, slots, side="right") - 1
            order = np.argsort(shard, kind="stable")
            cut = np.searchsorted(shard[order], np.arange(len(begins))).tolist()
            for i in range(len(begins) - 1):
                pick = order[cut[i] : cut[i + 1]]
                if len(pick):
                    here, place = np.unique(places[pick], return_inverse=True)
                    yield {"lang": lang, "shard": i, **packed([own[k][0] for k in here.tolist()], place, slots[pick] - begins[i], counts[pick])}
        self.groups, self.pairs, self.compact = {}, 0, 0


_COUNTS = f"lang string, shard int, part long, {_PACKED}, source string, term string, n long"
_PACKED_ARROW = [("sources", pa.list_(pa.string())), ("places", pa.binary()), ("slots", pa.binary()), ("counts", pa.binary()), ("totals", pa.list_(pa.int64()))]


def recount(docs: DataFrame, sent: Sent, cold: bool) -> DataFrame:
    """Per task and shard: packed counts of broadcast terms (part: the task); of other terms, if ``cold``: source, term and n."""
    schema = pa.schema([
        ("lang", pa.string()), ("shard", pa.int32()), ("part", pa.int64()), *_PACKED_ARROW, ("source", pa.string()), ("term", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, task = sent.derive(Lookup), TaskContext.get().partitionId()
        held, rest = _Held(lookup), {}

        def flush() -> Iterator[pa.RecordBatch]:
            rows = [row | {"part": task} for row in held.rows()]
            for at in range(0, len(rows), 256):
                yield pa.RecordBatch.from_pylist(rows[at : at + 256], schema=schema)

        def flush_rest() -> Iterator[pa.RecordBatch]:
            for (lang, source), counter in rest.items():
                terms_ = [t.decode("utf-8", "surrogatepass") for t in counter]
                size = len(terms_)
                columns = {"lang": pa.array([lang] * size, pa.string()), "source": pa.array([source] * size, pa.string()),
                           "term": pa.array(terms_, pa.string()), "n": pa.array(counter.values(), pa.int64())}
                yield pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(size, f.type)) for f in schema], schema=schema)
            rest.clear()

        for batch in slices(batches, 1000):
            texts: dict[str, dict[str, list]] = {}
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                texts.setdefault(lang, {}).setdefault(source, []).append(text)
            for lang, by_source in texts.items():
                words = {source: terms(" ".join(own)) for source, own in by_source.items()}
                number = {t: i for i, t in enumerate(set().union(*words.values()))}
                distinct = list(number)
                slot = lookup.slots(lang, distinct)
                for source, own in words.items():
                    n = np.bincount(np.fromiter(map(number.__getitem__, own), np.int64, len(own)), minlength=len(distinct))
                    here = np.flatnonzero((n > 0) & (slot >= 0))
                    held.add(lang, source, slot[here], n[here])
                    if cold:
                        counter = rest.setdefault((lang, source), Counter())
                        for i in np.flatnonzero((n > 0) & (slot < 0)).tolist():
                            counter[distinct[i]] += int(n[i])
                if held.full():
                    yield from flush()
                if sum(map(len, rest.values())) > FLUSH:
                    yield from flush_rest()
        yield from flush()
        yield from flush_rest()

    return docs.select("lang", "source", "text").mapInArrow(run, _COUNTS)


def summed(counts: DataFrame, fan: int) -> DataFrame:
    """One row per lang and shard: the sum of its packed rows, ``fan`` tasks' or fewer a step."""
    schema = pa.schema([("lang", pa.string()), ("shard", pa.int32()), ("part", pa.int64()), *_PACKED_ARROW])

    def add(rows: pa.Table) -> pa.Table:
        own = rows.to_pylist()
        sources = sorted({s for r in own for s in r["sources"]})
        size = 1 + max(int(np.frombuffer(r["slots"], "<u2").max()) for r in own)
        total = matrix(own, sources, size)
        places, slots = np.nonzero(total)
        one = {name: own[0][name] for name in ("lang", "shard", "part")}
        return pa.Table.from_pylist([one | packed(sources, places, slots, total[places, slots])], schema=schema)

    parts = (counts.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        parts = -(-parts // fan)
        counts = (
            counts.select("lang", "shard", F.floor(F.col("part") / fan).alias("part"), "sources", "places", "slots", "counts")
            .groupBy("lang", "shard", "part").applyInArrow(add, f"lang string, shard int, part long, {_PACKED}"))
        if parts == 1:
            return counts.drop("part")
        counts = saved(counts, "sums")


def _cold_counts(rows: DataFrame, hashes: DataFrame) -> DataFrame:
    """Packed counts of the terms that were not broadcast: the rows' sums, joined with the kept terms."""
    def number(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in frames:
            for row in batch.to_pylist():
                found = _term_array(row)
                n = row["size"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["lang"]] * n, pa.string()), pa.array([row["shard"]] * n, pa.int32()), found.cast(pa.large_string()).cast(pa.string()),
                     pa.array(np.arange(n, dtype=np.int32))], ["lang", "shard", "term", "slot"])

    slots = hashes.where("not hot").select("lang", "shard", "size", "ends", "terms").mapInArrow(number, "lang string, shard int, term string, slot int")
    total = rows.where("term is not null").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))
    schema = pa.schema([("lang", pa.string()), ("shard", pa.int32()), *_PACKED_ARROW])

    def pack(rows: pa.Table) -> pa.Table:
        one = {name: rows.column(name)[0].as_py() for name in ("lang", "shard")}
        source = rows.column("source").combine_chunks().dictionary_encode()
        row = packed(source.dictionary.to_pylist(), source.indices.to_numpy().astype(np.int64), rows.column("slot").to_numpy(), rows.column("n").to_numpy())
        return pa.Table.from_pylist([one | row], schema=schema)

    return total.join(slots, ["lang", "term"]).select("lang", "source", "shard", "slot", "n").groupBy("lang", "shard").applyInArrow(
        pack, f"lang string, shard int, {_PACKED}")


def probabilities(counts: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(SCALE (count + 1) / total) in 64 bits: the product is divided in two steps."""
    a, b = 40_000, SCALE // 40_000
    first = (counts + 1) * a
    return 1 + first // total * b + first % total * b // total


def compare(row: dict, top: int) -> Iterator[tuple]:
    """Of one shard: (source, part, item, value) for pairs of its groups, and for its terms the ``top`` of each group with all ties."""
    sources, kept = [g["source"] for g in row["groups"]], row["kept"]
    totals = np.array([g["n"] for g in row["groups"]], np.int64)
    counts = matrix([row] if row["sources"] is not None else [], sources, row["size"])
    p = probabilities(counts, totals[:, None] + kept)
    for other, q in enumerate(p):
        d = p - q
        for i, value in enumerate((d * d // q).sum(1).tolist()):
            if i != other:
                yield sources[i], "pair", sources[other], value
    q = probabilities(counts.sum(0), row["lang_n"] + kept)
    names = _term_array(row)
    d = np.where((counts > 0) & (p > q), p - q, -1)
    for i, own in enumerate(d):
        here = np.flatnonzero(own > 0)
        value = own[here] * own[here] // q[here]
        if len(here) > top:
            most = value >= np.partition(value, len(here) - top)[len(here) - top]
            here, value = here[most], value[most]
        for term, v in zip(names.take(pa.array(here)).to_pylist(), value.tolist()):
            yield sources[i], "term", term.decode("utf-8", "surrogatepass"), v


def audit(
    docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, broadcast: int = BROADCAST, fan: int = FAN,
) -> DataFrame:
    """lang, source, part (pair or term), item, value, rank (from 1 per lang, source and part)."""
    spark = docs.sparkSession
    empty = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
    docs = docs.select(empty("lang"), empty("source"), empty("text"))
    groups = saved(docs.select("lang", "source").distinct(), "groups")
    kept = saved(kept_terms(docs, groups, min_docs, broadcast), "kept")
    hashes = saved(perfect_hashes(kept), "hashes")
    cold = not hashes.where("not hot").isEmpty()
    sent = Sent(spark, [r.asDict() for r in hashes.where("hot").drop("hot").collect()])
    rows = saved(recount(docs, sent, cold), "counts")
    with rows_per_batch(spark, SHARDS):
        counts = summed(rows.where("term is null").drop("source", "term", "n"), fan).withColumn("hot", F.lit(True))
        if cold:
            counts = counts.unionByName(_cold_counts(rows, hashes).withColumn("hot", F.lit(False)))
        counts = saved(counts, "counts")

    own = counts.select("lang", F.inline(F.arrays_zip("sources", "totals"))).groupBy("lang", F.col("sources").alias("source")).agg(F.sum("totals").alias("n"))
    totals = saved(groups.join(own, ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n")), "totals")
    within = F.when(F.col("lang_n") < _MOST, F.col("lang_n")).otherwise(F.raise_error(F.lit("a language has too many occurrences")))
    # As many groups as a language has sources: its pairs of them are part of the result.
    langs = totals.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("groups"))
    langs = langs.withColumn("lang_n", within).join(kept.groupBy("lang").agg(F.count("*").alias("kept")), "lang")
    shards = (
        hashes.select("lang", "hot", "shard", "size", "ends", "terms")
        .join(counts.drop("totals"), ["lang", "hot", "shard"], "left").join(saved(langs, "langs"), "lang"))

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                columns = list(zip(*compare(row, top))) or [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["lang"]] * len(columns[0]), pa.string()),
                     *(pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.string(), pa.int64())))],
                    ["lang", "source", "part", "item", "value"])

    with rows_per_batch(spark, SHARDS):
        found = saved(shards.mapInArrow(values, "lang string, source string, part string, item string, value long"), "values")
    pairs = found.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    bare = totals.join(kept.select("lang").distinct(), "lang", "left_anti").select("lang", "source")
    zeros = bare.join(bare.withColumnRenamed("source", "item"), "lang").where("source != item").withColumn("value", F.lit(0).cast("long"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank: Column = F.row_number().over(ranked).alias("rank")
    pairs = pairs.unionByName(zeros).select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank)
    words = found.where("part = 'term'").select("lang", "source", "part", "item", "value", rank).where(F.col("rank") <= top)
    return pairs.unionByName(words)
