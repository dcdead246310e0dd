"""The mix against a plain draw, the registered queries against SQL, the pipeline stage by stage."""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import decontaminate, mixing, simhash, toxicity
from ledgerloom.llm.common import table
from ledgerloom.llm.oracles import ORACLES
from ledgerloom.llm.queries import QUERIES
from tests.llm.cases import awkward, frame, prose
from tests.test_queries import TABLES, table_of

SF_DIR = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="test tables are absent")


def uniform(*parts):
    return int(hashlib.md5("|".join(parts).encode()).hexdigest()[:13], 16) / 2**52


def draw(u, rate):
    p = c = math.exp(-rate)
    k = 0
    while u >= c and k < rate + 12 * math.sqrt(rate) + 30:
        k += 1
        p *= rate / k
        c += p
    return k


@pytest.mark.parametrize("size", [None, 12_000.0])
def test_copies_of_awkward_rows(spark, size):
    """The larger size needs rates over those of a single draw."""
    rows = awkward()
    weights = {"a": 3.0, "b": 0.0, None: 1.0}
    docs = frame(spark, rows)
    mixed = mixing.mix(docs, weights, size)
    assert mixed.columns == [c for c in docs.columns if c not in mixing.ADDED] + list(mixing.ADDED)
    n = Counter(r[3] for r in rows)
    want = Counter()
    for doc_id, text, _, source, _ in rows:
        rate = weights[source] * (size or len(rows)) / sum(weights.values()) / n[source]
        draws = math.ceil(max(rate / mixing.MOST_RATE, 1))
        key = ("" if doc_id is None else str(doc_id), text or "")
        copies = sum(draw(uniform(str(mixing.SEED), str(i), *key), rate / draws) for i in range(1, draws + 1))
        want[(doc_id, text)] += copies
    got = Counter({(r.doc_id, r.text): r["count"] for r in mixed.groupBy("doc_id", "text").count().collect()})
    assert got == +want
    assert not any(r.source == "b" for r in mixed.select("source").distinct().collect())
    assert mixing.mix(frame(spark, []), weights).count() == 0


def test_mean_rate_and_global_order(spark):
    rows = [(i, prose(i, 3), "en", "abc"[i % 3], 1) for i in range(3000)]
    mixed = mixing.mix(frame(spark, rows), {"a": 2.0, "b": 1.0, "c": 1.0})
    got = mixed.collect()
    share = Counter(r.source for r in got)
    assert share["a"] == pytest.approx(1500, abs=120) and share["b"] == pytest.approx(750, abs=90)
    assert [r.position for r in got] == sorted(r.position for r in got)
    first = [r.source for r in got[:600]]
    assert Counter(first)["a"] == pytest.approx(300, abs=60)


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    result = QUERIES[name](spark, SF_DIR)
    got = table_of(result.columns, [tuple(r) for r in result.collect()])
    cursor = duck.execute(ORACLES[name])
    assert got == table_of([d[0] for d in cursor.description], cursor.fetchall())


@needs_tables
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_query_returns_a_row_for_each_of_its_table(spark, name):
    result = QUERIES[name](spark, SF_DIR)
    if name not in ("op6_mix", "op11_divergence"):
        source = table(spark, SF_DIR, "pages" if name.startswith("op5") else "documents")
        assert result.count() == source.count()
    assert not {t for _, t in result.dtypes} & {"void"}


def pipeline_by_hand(spark, docs, benchmark, labels):
    """Every stage by its rule in plain Python, on the whole output of the one before; the toxicity model is the operator's."""
    model = toxicity.train(docs, labels)
    bad = Counter((r.doc_id) for r in toxicity.score_toxicity(docs, model).where("predicted = 1").collect())
    rows = [r for r in docs.collect() if r.doc_id not in bad]
    last = {}
    for r in rows:
        last[r.text or ""] = max(last.get(r.text or "", -1), r.doc_id)
    rows = [r for r in rows if last[r.text or ""] == r.doc_id]
    fp = [simhash.fingerprint(r.text or "") for r in rows]
    root = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                if root[i] != root[j] and (fp[i] ^ fp[j]).bit_count() <= 3:
                    root[i] = root[j] = min(root[i], root[j])
                    changed = True
    least = {}
    for r, k in zip(rows, root):
        least[k] = min(least.get(k, r.doc_id), r.doc_id)
    rows = [r for r, k in zip(rows, root) if least[k] == r.doc_id]
    patterns = decontaminate.automaton([(str(r.item_id), r.text) for r in benchmark.collect()])
    clean = []
    for r in rows:
        n, _, runs, _ = decontaminate.find(r.text or "", patterns)
        hit = sum(x["last"] - x["first"] for x in runs)
        if not (hit > 0 and 20 * hit >= n):
            clean.append(r.doc_id)
    return sorted(clean)


@needs_tables
def test_pipeline(spark):
    docs = table(spark, SF_DIR, "documents")
    want = pipeline_by_hand(spark, docs, table(spark, SF_DIR, "benchmark"), table(spark, SF_DIR, "labels"))
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, now = now, corpus_pipeline.saved(stage(spark, now, SF_DIR), name)
        assert now.schema == before.schema, name
        assert now.count() <= before.count()
    assert sorted(r.doc_id for r in now.select("doc_id").collect()) == want
    mixed = corpus_pipeline.run(spark, SF_DIR)
    assert {r.doc_id for r in mixed.select("doc_id").collect()} <= set(want)
    assert mixed.groupBy("doc_id", "copy_no").count().where(F.col("count") > 1).count() == 0
