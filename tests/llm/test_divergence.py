"""The divergence audit against a plain version in Python integers."""

from __future__ import annotations

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import divergence, oracles
from tests.llm.cases import awkward, frame, prose

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def by_hand(rows, min_docs=3, top=200):
    texts = [
        (lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        for _, text, lang, source, _ in rows]
    docs = Counter((lang, t) for lang, _, words in texts for t in set(words))
    kept = {lang: [t for (own, t), n in docs.items() if own == lang and n >= min_docs] for lang, _, _ in texts}
    count = Counter((lang, source, t) for lang, source, words in texts for t in words if docs[lang, t] >= min_docs)
    out = []
    for lang, terms in kept.items():
        sources = sorted({s for own, s, _ in texts if own == lang})
        def p_of(n):
            total = sum(n.values())
            return {t: 1 + 1000000000 * (n[t] + 1) // (total + len(terms)) for t in terms}
        p = {s: p_of({t: count[lang, s, t] for t in terms}) for s in sources}
        q = p_of({t: sum(count[lang, s, t] for s in sources) for t in terms})
        for s in sources:
            pairs = [(o, sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in terms)) for o in sources if o != s]
            words = [(t, (p[s][t] - q[t]) ** 2 // q[t]) for t in terms if count[lang, s, t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", words)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(items[: top if part == "term" else None])]
    return sorted(out)


def some_rows():
    rng = random.Random(5)
    rows = awkward()
    for k in range(120):
        words = prose(rng.randrange(60), rng.randint(0, 60)).split() + rng.choices(["Alpha", "beta", "GAMMA9delta", "é", "ÉÉ", "x"], k=rng.randint(0, 6))
        rows.append((100 + k, rng.choice([" ", ", ", "-"]).join(words), rng.choice(["en", "en", "de", "fr"]), rng.choice("abc"), 1))
    rows += [(300 + i, "solo zwei", "it", "only", 1) for i in range(3)]  # one source: no pairs
    rows += [(310, "uno", "pt", "a", 1), (311, "due", "pt", "b", 1), (312, None, "pt", "c", 1)]  # no kept term
    rows += [(320, "1 2 3", "en", "no terms", 1)]
    return rows


def found(df):
    assert df.columns == COLUMNS
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("broadcast, fan", [(divergence.BROADCAST, divergence.FAN), (0, 64), (900, 2)])
def test_by_hand(spark, broadcast, fan):
    """With all terms broadcast, with none, and with some and a tree of sums of several steps."""
    rows = some_rows()
    docs = frame(spark, rows).repartition(7)
    want = by_hand(rows)
    assert found(divergence.audit(docs, broadcast=broadcast, fan=fan)) == want
    assert {"pair", "term"} == {r[2] for r in want} and any(r[0] == "pt" and r[4] == 0 for r in want)


def test_top_and_ties(spark, monkeypatch):
    """Many terms of equal value: the smallest in UTF-8 order stay; several shards."""
    monkeypatch.setattr(divergence, "SHARD_TERMS", 64)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    rows = [(i, " ".join(words), "en", "a", 1) for i in range(3)] + [(9, "other " * 50, "en", "b", 1)] * 3
    assert found(divergence.audit(frame(spark, rows), top=20)) == by_hand(rows, top=20)


def test_flushes(spark, monkeypatch):
    """Tasks that send on what they hold after every group."""
    monkeypatch.setattr(divergence, "HELD", 1)
    monkeypatch.setattr(divergence, "FLUSH", 1)
    rows = [r for r in some_rows() if r[0] != 6]
    assert found(divergence.audit(frame(spark, rows).coalesce(2), broadcast=600)) == by_hand(rows)


def test_empty(spark):
    assert found(divergence.audit(frame(spark, []))) == []
    none = [(None, None, None, None, None), (1, "", "", "b", 0)]
    assert found(divergence.audit(frame(spark, none))) == by_hand(none) == [("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)]


def test_sql(spark, tmp_path):
    rows = some_rows()
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(con.execute(oracles.ORACLES["op11_divergence"]).fetchall()) == by_hand(rows)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=6), max_size=400), st.lists(st.binary(max_size=6), max_size=50))
def test_perfect_hash(words, others):
    """Slots are 0..n-1, each once; terms that aren't there may get any slot or none."""
    words = sorted(words)
    own = divergence.PerfectHash.build(divergence.hashed(words))
    both = divergence.PerfectHash.joined([divergence.PerfectHash.build(divergence.hashed([b"a", b"b"])), own])
    slots = both.slots(divergence.hashed(words), np.ones(len(words), np.int64))
    assert sorted(slots.tolist()) == list(range(len(words)))
    other = both.slots(divergence.hashed(others), np.ones(len(others), np.int64))
    assert all(-1 <= x < len(words) for x in other.tolist())


def test_equal_hashes_are_an_error():
    with pytest.raises(ValueError):
        divergence.PerfectHash.build(np.array([5, 5], np.uint64))


@given(st.integers(0, (1 << 46) - 1), st.integers(1, 1 << 46))
def test_probabilities_are_exact(count, more):
    total = count + more
    assert int(divergence.probabilities(np.array([count]), np.array([total]))[0]) == 1 + 1000000000 * (count + 1) // total
