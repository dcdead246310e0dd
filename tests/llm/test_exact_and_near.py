"""Exact and near copies against plain loops."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import exact_dedup, simhash
from ledgerloom.llm.common import FILE, ROW, shared_dir
from tests.llm.cases import awkward, frame, prose, sorted_rows


def expected_groups(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(text or "", []).append(doc_id)
    return sorted(
        ((d, max((x for x in groups[t or ""] if x is not None), default=None), len(groups[t or ""]),
          hashlib.sha256((t or "").encode()).hexdigest()) for d, t, *_ in rows), key=repr)


def test_exact_groups_of_awkward_rows(spark):
    rows = awkward()
    found = exact_dedup.exact_groups(frame(spark, rows)).cache()
    assert sorted_rows(found, "doc_id", "keep_id", "group_size", "digest") == expected_groups(rows)
    kept = found.where("kept").collect()
    assert len(kept) == len({t or "" for _, t, *_ in rows})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_colliding_digests_are_told_apart_by_their_bytes(spark):
    rows = [(i, f"text {i // 2}", "en", "a", 1) for i in range(20)]
    one_digit = lambda text: F.substring(F.sha2(text, 256), 1, 1)
    found = exact_dedup.exact_groups(frame(spark, rows), one_digit)
    assert sorted_rows(found, "doc_id", "keep_id", "group_size") == [(i, i // 2 * 2 + 1, 2) for i in sorted(range(20), key=lambda i: repr((i, i // 2 * 2 + 1, 2)))]


def test_exact_dedup_keeps_all_columns_and_one_row_of_each_text(spark):
    docs = frame(spark, awkward())
    kept = exact_dedup.deduplicated(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({t or "" for _, t, *_ in awkward()})


def test_state_remembers_earlier_batches(spark, tmp_path):
    """Copies that arrive in later runs of the stream still meet the first one."""
    source, state, out = str(tmp_path / "in"), shared_dir(spark, "state"), shared_dir(spark, "groups")
    schema = f"digest string, doc_id long, {FILE} string, {ROW} long"
    for run, ids in enumerate([(1, 2), (9,), (3,)]):
        rows = [("same", i, "f", i) for i in ids] + [(f"own {i}", i, "f", i) for i in ids]
        spark.createDataFrame(rows, schema).write.mode("append").parquet(source)
        exact_dedup.keep_state(spark.readStream.schema(schema).parquet(source), state, out)
        got = {r.digest: (r.stays.doc_id, r.group_size) for r in exact_dedup.groups(spark, out).collect()}
        assert got["same"] == [(2, 2), (9, 3), (9, 4)][run]
    assert got["own 3"] == (3, 1)


@pytest.mark.parametrize("text,words", [("", 0), ("One", 1), ("one TWO", 2), ("a b c", 3), ("a b a b a b a", 7), (prose(4, 500), 500)])
def test_fingerprint_by_definition(text, words):
    import xxhash

    tokens = text.encode().lower().split()
    shingles = [b" ".join(tokens[i : i + 3]) for i in range(max(1, len(tokens) - 2))] if tokens else []
    values = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    want = sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))
    assert len(tokens) == words
    assert simhash.fingerprint(text) == want


def near_pairs(fp: list[int], radius: int = 3) -> set[tuple[int, int]]:
    return {(i, j) for i in range(len(fp)) for j in range(i + 1, len(fp)) if bin(fp[i] ^ fp[j]).count("1") <= radius}


def clustered(rng: np.random.Generator, centres: int, each: int, flips: int) -> list[int]:
    out = set()
    for _ in range(centres):
        centre = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        for _ in range(each):
            x = centre
            for b in rng.choice(64, int(rng.integers(0, flips + 1)), replace=False):
                x ^= 1 << int(b)
            out.add(x)
    return sorted(out)


def components(n: int, pairs) -> list[int]:
    root = list(range(n))
    for _ in range(n):
        before = list(root)
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    return root


@pytest.mark.parametrize("size", [300])
def test_tree_finds_all_pairs(size):
    rng = np.random.default_rng(5)
    fp = np.array(clustered(rng, 6, size // 6, 5), dtype=np.uint64)
    found = {(min(a, b), max(a, b)) for i, j in simhash.tree_pairs(fp, leaf=8) for a, b in zip(i.tolist(), j.tolist())}
    assert found == near_pairs([int(x) for x in fp])


@pytest.mark.parametrize("shard,blocks", [(4096, 8), (8, 8), (16, 4)])
def test_links_connect_what_brute_force_connects(spark, shard, blocks):
    rng = np.random.default_rng(shard)
    fp = clustered(rng, 12, 25, 4) + [0, 1, 3, 7, 15, 31]
    fp = sorted(set(fp))
    want = components(len(fp), near_pairs(fp))
    ids = np.array(fp, dtype=np.uint64).view(np.int64).tolist()
    reps = spark.createDataFrame([(x, x) for x in ids], "id long, fp long")
    found = [tuple(r) for r in simhash.links(reps, blocks, shard).collect()]
    at = {x: i for i, x in enumerate(ids)}
    pairs = {(at[a], at[b]) for a, b in found}
    assert all(bin(fp[a] ^ fp[b]).count("1") <= 3 or want[a] == want[b] for a, b in pairs)
    assert components(len(fp), pairs) == want


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r.id: r.component for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 140)}}


def test_near_duplicates_of_awkward_rows(spark):
    rows = awkward() + [(20, prose(9, 300), "en", "a", 1), (21, prose(9, 300) + " end", "en", "a", 1)]
    docs = frame(spark, rows)
    found = simhash.near_duplicates(docs).select("doc_id", "fp", "component_id").collect()
    fps = [simhash.fingerprint(t or "") for _, t, *_ in rows]
    root = components(len(rows), near_pairs(fps))
    want = []
    for i, (doc_id, *_) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[i] and rows[j][0] is not None]
        want.append((doc_id, int(np.uint64(fps[i]).view(np.int64)), min(ids, default=None)))
    assert sorted((tuple(r) for r in found), key=repr) == sorted(want, key=repr)
    kept = simhash.representatives(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len(set(root))


def test_empty_tables(spark):
    docs = frame(spark, [])
    assert exact_dedup.exact_groups(docs).count() == 0
    assert exact_dedup.deduplicated(docs).count() == 0
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.representatives(docs).count() == 0
