"""SimHash near-dedup: fingerprints linked by exact Hamming search over vantage-point shards.

A fingerprint bit is 1 if set in over half of the XXH64 values of a text's word shingles.
Two fingerprints link at ``RADIUS`` = 3 or fewer differing bits; groups are the connected
components.

Search. A pair within 3 bits is within 1 bit in one half of the fingerprint, so each half is
partitioned on its own. The half is cut into ``BLOCKS`` equal blocks with a vantage point
each; a fingerprint's shard is the vector of its blocks' Hamming distances to those points.
Moving one bit changes one distance by one (the triangle bound), so a partner lies in the
same shard or in one that differs by one step in one block. Each fingerprint has a home
shard and sends a copy to the shards one step lower (the pairs across an upper border are
found by the other side's copy): 1 + BLOCKS rows per half, however the data lie. Within a
shard, small groups are compared at once and larger ones searched through a vantage-point
tree with triangle bounds. Every pair found is checked on all 64 bits.

Skew. Copies collapse to one fingerprint first. A shard of more than ``SHARD`` rows is dealt
by hash into chunks and every pair of chunks is compared in a task group of its own, so no
group exceeds 2 x SHARD rows and no pair is lost. A group emits a spanning forest of its
links, never all pairs. Components come from alternating large-star and small-star steps,
whose states are written to the shared folder.

Defined results: null and empty texts have fingerprint zero and link like any other. A null
doc_id gets the smallest known id of its component, null if there is none. Rows with the
same doc_id are reported one by one. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import FILE, ROW, file_backed, located, saved

SHINGLE, SEED, RADIUS = 3, 42, 3
#: Blocks of each half; 32 must be divisible by it.
BLOCKS = 8
#: Rows of a shard beyond which it is dealt into chunks.
SHARD = 4096
#: Vantage points of the two halves, any fixed bits do.
VANTAGE = 0x9E3779B97F4A7C15

_shingle_hash = xxhash.xxh64_intdigest


def fingerprint(text: str | bytes, width: int = SHINGLE) -> int:
    data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text
    words = data.lower().split()  # for bytes: at ASCII white space, A-Z only
    if not words:
        return 0
    if len(words) <= width:
        return _shingle_hash(b" ".join(words), SEED)
    total = np.zeros(64, np.int64)
    n = len(words) - width + 1
    for at in range(0, n, 65_536):
        part = words[at : at + 65_536 + width - 1]
        rows = [b" ".join(x) for x in zip(*(part[k:] for k in range(width)))]
        values = np.array([_shingle_hash(x, SEED) for x in rows], dtype="<u8")
        bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id, locator and fp (the fingerprint's 64 bits as a signed long) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(x or b"", width) for x in batch.column("text").to_pylist()]
            fp = pa.array(np.array(values, dtype=np.uint64).view(np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.select(["doc_id", FILE, ROW]).columns, fp], ["doc_id", FILE, ROW, "fp"])

    rows = located(docs.select("doc_id", "text")).withColumn("text", F.col("text").cast("binary"))
    return rows.mapInArrow(mark, f"doc_id {kind}, {FILE} string, {ROW} long, fp long")


def popcount(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values).astype(np.int64)


def routes(fp: np.ndarray, blocks: int = BLOCKS) -> tuple[np.ndarray, np.ndarray]:
    """Rows (positions in ``fp``) and shard keys: both halves, home and one step lower in each block."""
    width = 32 // blocks
    rows, keys = [], []
    for half in (0, 1):
        x = ((fp ^ np.uint64(VANTAGE)) >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        d = np.stack([popcount((x >> np.uint64(width * b)) & np.uint64((1 << width) - 1)) for b in range(blocks)])
        place = np.array([(width + 1) ** b for b in range(blocks)], dtype=np.int64)
        home = (d * place[:, None]).sum(0) * 2 + half
        rows.append(np.arange(len(fp)))
        keys.append(home)
        for b in range(blocks):
            lower = np.flatnonzero(d[b])
            rows.append(lower)
            keys.append(home[lower] - 2 * place[b])
    return np.concatenate(rows), np.concatenate(keys)


def tree_pairs(fp: np.ndarray, radius: int = RADIUS, leaf: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs within the radius, by a vantage-point tree walked with all queries at once."""
    stack = [(np.arange(len(fp)), np.arange(len(fp)))]  # queries, members of the branch
    while stack:
        queries, members = stack.pop()
        if not len(queries) or not len(members):
            continue
        if len(members) <= leaf:
            near = popcount(fp[queries][:, None] ^ fp[members][None, :]) <= radius
            i, j = np.nonzero(near & (queries[:, None] < members[None, :]))
            yield queries[i], members[j]
            continue
        vantage = fp[members[0]]
        d = popcount(fp[members] ^ vantage)
        middle = np.median(d)
        inner = d <= middle
        if inner.all() or not inner.any():  # one shell: no bound can prune it
            for at in range(0, len(members), leaf):
                stack.append((queries, members[at : at + leaf]))
            continue
        q = popcount(fp[queries] ^ vantage)
        stack.append((queries[q <= middle + radius], members[inner]))
        stack.append((queries[q > middle - radius], members[~inner]))


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest position reachable from each position."""
    root = list(range(n))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for left, right in pairs:
        for a, b in zip(left.tolist(), right.tolist()):
            a, b = top(a), top(b)
            if a != b:
                root[max(a, b)] = min(a, b)
    return np.array([top(x) for x in range(n)], dtype=np.int64)


def group_links(ids: np.ndarray, fp: np.ndarray, group: np.ndarray, small: int = 48) -> tuple[np.ndarray, np.ndarray]:
    """Links within groups of consecutive rows, as pairs of ids that span each group's components."""
    starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(group)])))
    left, right = [], []
    few = np.repeat(sizes <= small, sizes)
    for step in range(1, int(sizes[sizes <= small].max(initial=0))):
        i = np.flatnonzero(few[:-step] & (group[step:] == group[:-step]) & (popcount(fp[step:] ^ fp[:-step]) <= RADIUS))
        left.append(ids[i])
        right.append(ids[i + step])
    for start, size in zip(starts[sizes > small], sizes[sizes > small]):
        part = slice(start, start + size)
        top = forest(size, tree_pairs(fp[part]))
        inner = np.flatnonzero(top != np.arange(size))
        left.append(ids[part][top[inner]])
        right.append(ids[part][inner])
    return np.concatenate([*left, ids[:0]]), np.concatenate([*right, ids[:0]])


def links(reps: DataFrame, blocks: int = BLOCKS, shard: int = SHARD) -> DataFrame:
    """Links (a, b) between ids of different fingerprints; ``reps``: id, fp, one row per fingerprint."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False)
            rows, keys = routes(fp.view(np.uint64), blocks)
            picked = batch.select(["id", "fp"]).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([pa.array(keys), *picked.columns], ["shard", "id", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new]).combine_chunks()
            last = held.slice(held.num_rows - 1, 1)
            group = _group(held)
            done = int(np.searchsorted(group, _group(last, held)[0]))  # the last group may go on in the next batch
            yield from found(held.slice(0, done), group[:done])
            held = held.slice(done)
        if held is not None:
            yield from found(held, _group(held))

    def _group(rows: pa.Table, within: pa.Table | None = None) -> np.ndarray:
        """Consecutive numbers of the groups of sorted rows."""
        whole = within or rows
        keys = [whole.column(k).to_numpy() for k in ("shard", "part")]
        new = np.zeros(whole.num_rows, bool)
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        numbers = np.cumsum(new)
        return numbers[-rows.num_rows:] if within is not None else numbers

    def found(rows: pa.Table, group: np.ndarray) -> Iterator[pa.RecordBatch]:
        if rows.num_rows:
            a, b = group_links(rows.column("id").to_numpy(), rows.column("fp").to_numpy().view(np.uint64), group)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    routed = saved(reps.mapInArrow(route, "shard long, id long, fp long"), "routes")
    sizes = routed.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1")
    # A chunk number per row; a row of chunk c joins the groups (c, d) for all d. One chunk: group 0.
    chunks = F.ceil(F.col("n") / shard).cast("int")
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda d: F.least(d, chunk) * F.col("chunks") + F.greatest(d, chunk))
    grouped = (
        routed.join(sizes, "shard").withColumn("chunks", chunks)
        .select("shard", "id", "fp", F.explode(F.when(F.col("chunks") == 1, F.array(F.lit(0))).otherwise(pairs)).alias("part"))
        .repartition("shard", "part").sortWithinPartitions("shard", "part")
    )
    return grouped.mapInArrow(compare, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Per id with a link: id, component (smallest id reachable). Large-star and small-star in turn."""

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        side = both if large else both.where("b < a")
        least = side.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        moved = side.join(least, "a").where("b > a" if large else "b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        if not large:
            moved = moved.union(least.where("a != m").select("a", F.col("m").alias("b")))
        return moved.where("a != b").distinct()

    edges, before = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "edges"), None
    while True:
        edges = saved(star(star(edges, large=True), large=False), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
                edges.select("b", "b").distinct())
        before = now


def near_duplicates(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """Per row: doc_id, locator, fp, component_id."""
    marked = saved(fingerprints(docs.select(F.col("doc_id").cast("long"), "text"), width), "fingerprints")
    classes = saved(marked.groupBy("fp").agg(F.min("doc_id").alias("smallest")), "classes")
    # Inside, a fingerprint is its own id: ids of documents may be null or repeat.
    joined = components(links(classes.select(F.col("fp").alias("id"), "fp")))
    named = classes.join(joined.withColumnRenamed("id", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("smallest").alias("component_id"))
    labels = named.join(least, "component").select("fp", "component", "component_id")
    return marked.join(labels, "fp")


def representatives(docs: DataFrame) -> DataFrame:
    """One row of each component stays, with all its columns: that with the smallest doc_id, ties by locator."""
    docs = file_backed(docs)
    found = near_duplicates(docs)
    stays = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", FILE, ROW)).alias("s"))
    return located(docs).join(stays.select(f"s.{FILE}", f"s.{ROW}"), [FILE, ROW], "left_semi").drop(FILE, ROW)
