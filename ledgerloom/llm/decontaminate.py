"""Benchmark decontamination: one Aho-Corasick automaton over normalised benchmark windows.

Texts are put in lower case (A-Z only) and cut into words; a window is ``WINDOW``
consecutive words of an item, or the whole of a shorter item. Windows of words joined by
single spaces go into one automaton; each document is joined the same way and scanned once.
Hits are counted in words and mapped to character offsets of the original text.

The benchmark is broadcast, so its size is checked first: beyond ``max_chars`` it is split
into parts by hash, each part is scanned on its own and the hits of the parts are united
(a text then lists the spans of every part, which may overlap).

Defined results: a null or empty text has no words, no hits and no items. An item without
words has no window. Items with the same id count once; rows with the same doc_id are
reported one by one. Empty tables give empty results. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ledgerloom.llm.common import FILE, ROW, Sent, file_backed, fold, located, strings

WINDOW = 13
#: Characters of benchmark text in one broadcast and one automaton: about 200 MB in a worker.
MAX_CHARS = 2_000_000

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_HITS = "items array<string>, runs array<struct<first:int,last:int>>, spans array<struct<begin:int,end:int>>"


def windows(words: list[str], size: int = WINDOW) -> list[tuple[str, ...]]:
    """All runs of ``size`` words, the whole of a shorter list, nothing of an empty one."""
    if not words:
        return []
    return [tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


def automaton(items: list[tuple[str, str]], size: int = WINDOW) -> ahocorasick.Automaton:
    """Each pattern carries its number of words and the items that have it."""
    owners: dict[tuple[str, ...], set[str]] = defaultdict(set)
    for item_id, text in items:
        for window in windows(WORD.findall(fold(text)), size):
            owners[window].add(item_id)
    found = ahocorasick.Automaton()
    for window, ids in owners.items():
        found.add_word(f" {' '.join(window)} ", (len(window), sorted(ids)))
    if owners:
        found.make_automaton()
    return found


def find(text: str, patterns: ahocorasick.Automaton) -> tuple[int, list[str], list[dict], list[dict]]:
    """Number of words, items found, hit runs in words (last exclusive) and in characters."""
    folded = fold(text)
    words = WORD.findall(folded)
    if not words or not len(patterns):
        return len(words), [], [], []
    matches = list(patterns.iter(f" {' '.join(words)} "))
    if not matches:
        return len(words), [], [], []
    ends = np.cumsum([len(w) + 1 for w in words])
    last = np.searchsorted(ends, [end for end, _ in matches]) + 1
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, last - np.array([n for _, (n, _) in matches]), 1)
    np.add.at(step, last, -1)
    hit = np.concatenate(([0], (np.cumsum(step[:-1]) > 0).astype(np.int8), [0]))
    edges = np.flatnonzero(np.diff(hit)).reshape(-1, 2)
    at = [m.span() for m in WORD.finditer(folded)]
    runs = [{"first": int(a), "last": int(b)} for a, b in edges]
    spans = [{"begin": at[r["first"]][0], "end": at[r["last"] - 1][1]} for r in runs]
    return len(words), sorted({i for _, (_, ids) in matches for i in ids}), runs, spans


def _patterns(sent: tuple[list[tuple[str, str]], int]) -> ahocorasick.Automaton:
    return automaton(*sent)


def _scanner(items: Sent, keys: list[str], schema: pa.Schema, hits_only: bool) -> Callable:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = items.derive(_patterns)
        for batch in batches:
            found = [find(text, patterns) for text in strings(batch.column("text"))]
            rows = [i for i, f in enumerate(found) if f[1] or not hits_only]
            left = batch.select(keys).take(pa.array(rows, pa.int64()))
            right = [pa.array([found[i][k] for i in rows], schema.field(len(keys) + k).type) for k in range(4)]
            yield pa.RecordBatch.from_arrays([*left.columns, *right], schema=schema)

    return scan


def parts_of(benchmark: DataFrame, max_chars: int = MAX_CHARS) -> tuple[int, DataFrame]:
    """Number of parts and the items with their part; the size is summed before anything is sent out."""
    bench = benchmark.select(F.col("item_id").cast("string"), "text").where("item_id is not null and text is not null")
    chars = bench.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    parts = max(1, math.ceil(chars / max_chars))
    return parts, bench.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)))


def _sent(bench: DataFrame, part: int, window: int) -> Sent:
    rows = bench.where(F.col("part") == part).select("item_id", "text").collect()
    return Sent(bench.sparkSession, ([tuple(r) for r in rows], window))


def _found(frame: DataFrame, items: Sent, keys: list[str], hits_only: bool) -> DataFrame:
    extra = frame.sparkSession.createDataFrame([], f"n_words long, {_HITS}").schema
    out = type(extra)(frame.select(*keys).schema.fields + extra.fields)
    arrow = pa.schema([(f.name, to_arrow_type(f.dataType)) for f in out.fields])
    return frame.select(*keys, "text").mapInArrow(_scanner(items, keys, arrow, hits_only), out)


def _in_parts(rows: DataFrame, keys: list[str], parts: int, bench: DataFrame, window: int) -> DataFrame:
    """Hits of every part, united by the rows' locators."""
    each = _found(rows, _sent(bench, 0, window), keys, hits_only=False)
    for part in range(1, parts):
        each = each.union(_found(rows, _sent(bench, part, window), keys, hits_only=True))
    united = {name: F.array_sort(F.array_distinct(F.flatten(F.collect_list(name)))) for name in ("items", "runs", "spans")}
    merged = each.groupBy(FILE, ROW).agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        *(column.alias(name) for name, column in united.items()))
    words = F.expr("array_distinct(flatten(transform(runs, r -> sequence(r.first, r.last - 1))))")
    return merged.withColumn("n_hit", F.size(words).cast("long"))


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_chars: int = MAX_CHARS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, items (ids as sorted strings), spans (character offsets)."""
    parts, bench = parts_of(benchmark, max_chars)
    if parts == 1:
        hits = _found(docs, _sent(bench, 0, window), ["doc_id"], hits_only=False)
        hits = hits.withColumn("n_hit", F.expr("aggregate(runs, 0L, (n, r) -> n + r.last - r.first)"))
    else:
        hits = _in_parts(located(docs.select("doc_id", "text")), ["doc_id", FILE, ROW], parts, bench, window)
    return hits.select("doc_id", "n_words", "n_hit", "items", "spans")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_chars: int = MAX_CHARS) -> DataFrame:
    """The rows that aren't contaminated, with all their columns."""
    parts, bench = parts_of(benchmark, max_chars)
    if parts > 1:
        docs = file_backed(docs)
        hits = _in_parts(located(docs.select("doc_id", "text")), ["doc_id", FILE, ROW], parts, bench, window)
        return located(docs).join(hits.where(contaminated()).select(FILE, ROW), [FILE, ROW], "left_anti").drop(FILE, ROW)
    items = _sent(bench, 0, window)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = items.derive(_patterns)
        for batch in batches:
            found = (find(text, patterns) for text in strings(batch.column("text")))
            hit = ((n, sum(r["last"] - r["first"] for r in runs)) for n, _, runs, _ in found)
            yield batch.filter(pa.array([not (h > 0 and 20 * h >= n) for n, h in hit], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def contaminated(n_words: str = "n_words", n_hit: str = "n_hit"):
    """At least one word in twenty is hit."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))
