"""Learnt operators: against plain loops where there is one, else on held-out rows."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import context_tree, quality, toxicity
from ledgerloom.llm.common import in_fold, saved
from tests.llm.cases import awkward, frame, prose

LABELS = "doc_id long, quality int, toxic int, note string"


def kt(n0, n1):
    return math.lgamma(n0 + 0.5) + math.lgamma(n1 + 0.5) - math.lgamma(n0 + n1 + 1) - math.log(math.pi)


def tree_scores(rows, depth):
    """The whole tree in dictionaries, walked byte by byte."""
    learns = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 != 2 for d, *_ in rows]
    texts = [b" ".join((t or "").encode().lower().split()) + b"\n" for _, t, *_ in rows]
    counts = defaultdict(lambda: [0, 0])

    def steps(text):
        data = b"\n" * depth + text
        for i in range(depth, len(data)):
            for k in range(8):
                code, bit = (1 << k) | (data[i] >> (8 - k)), data[i] >> (7 - k) & 1
                yield [(code, data[i - d : i]) for d in range(depth + 1)], bit

    for text, learn in zip(texts, learns):
        if learn:
            for path, bit in steps(text):
                for node in path:
                    counts[node][bit] += 1
    weighted, below = {}, defaultdict(float)
    for node in sorted(counts, key=lambda n: -len(n[1])):
        p = kt(*counts[node])
        weighted[node] = p if len(node[1]) == depth else np.logaddexp(math.log(0.5) + p, math.log(0.5) + below[node])
        if node[1]:
            below[(node[0], node[1][1:])] += weighted[node]
    out = []
    for text in texts:
        total = 0.0
        for path, bit in steps(text):
            seen = [n for n in path if n in counts] or [None]
            chance = 0.5
            for n in reversed(seen):
                if n is None:
                    continue
                one = (counts[n][1] + 0.5) / (sum(counts[n]) + 1)
                stop = 1.0 if n == seen[-1] else math.exp(math.log(0.5) + kt(*counts[n]) - weighted[n])
                chance = stop * one + (1 - stop) * chance
            total += math.log10(chance if bit else 1 - chance)
        out.append(total)
    train = Counter()
    for text, learn in zip(texts, learns):
        if learn:
            train.update(text.split() + [b"\n"])
    n, v = sum(train.values()), len(train)
    base = [sum(math.log10((train[w] + 1) / (n + v + 1)) for w in t.split() + [b"\n"]) for t in texts]
    known = [sum(train[w] > 0 for w in t.split() + [b"\n"]) for t in texts]
    return [(d, len(t.split()) + 1, k, n, round(b, 6), round(s, 6)) for (d, *_), t, k, b, s in zip(rows, texts, known, base, out)]


@pytest.mark.parametrize("depth,tables", [(6, (1 << 20, 1 << 19)), (3, (40, 5)), (2, (0, 0))])
def test_context_tree_by_definition(spark, depth, tables):
    """Also with tables so small that most strings and words take the join."""
    rows = [r for r in awkward() if len(r[1] or "") < 2000] + [(30 + i, prose(i, 12), "en", "a", 1) for i in range(25)]
    found = context_tree.score_texts(frame(spark, rows), depth=depth, grams=tables[0], tokens=tables[1]).collect()
    got = [(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in found]
    assert sorted(got, key=repr) == sorted(tree_scores(rows, depth), key=repr)


def test_context_tree_without_training_rows(spark):
    docs = frame(spark, [(1, "ab", "en", "a", 1)])
    row = context_tree.score_texts(docs, F.lit(False)).first()
    assert (row.n_known, row.train_tokens) == (0, 0)
    assert row.score == pytest.approx(24 * math.log10(0.5))
    assert context_tree.score_texts(frame(spark, [])).count() == 0


def test_context_tree_sends_missing_strings_packed(spark, monkeypatch):
    """Not a row per text and string: such rows cost most of the time of larger tables."""
    kept = {}
    monkeypatch.setattr(context_tree, "saved", lambda df, name, *a: kept.setdefault(name, saved(df, name, *a)))
    monkeypatch.setattr(context_tree, "_PART_BITS", (2, 4), raising=False)
    rows = [(i, prose(i, 200), "en", "a", 1) for i in range(100)]
    found = context_tree.score_texts(frame(spark, rows).coalesce(2), grams=0)
    assert kept["scored"].where("kind = 2").count() < kept["strings"].count() / 20
    whole = context_tree.score_texts(frame(spark, rows))
    assert {r.doc_id: round(r.score, 6) for r in found.collect()} == {r.doc_id: round(r.score, 6) for r in whole.collect()}


def test_context_tree_words_and_nodes():
    """Of whole batches as of single texts and strings."""
    rng = random.Random(3)
    texts = [bytes(rng.choice([*range(256), *b"  \t\nAZ"]) for _ in range(rng.randint(0, 30))) for _ in range(500)] + [None, b"", b" \n", bytes(range(256))]
    plain = [(t or b"").lower().split() for t in texts]
    joined, words, lengths = context_tree.words_of(pa.array([b"x", *texts], pa.binary()).slice(1))
    assert joined == [b" ".join(w) + b"\n" for w in plain]
    assert (words.to_pylist(), lengths.tolist()) == ([w for x in plain for w in x], [len(x) for x in plain])

    grams, n = np.unique(context_tree.packed(joined, 3)[0], return_counts=True)
    level, at = context_tree.decisions(grams, n, 3)
    seen = defaultdict(lambda: [0, 0])
    for gram, times, nodes in zip(grams.tolist(), n.tolist(), at.T):
        *context, byte = gram.to_bytes(4, "big")
        for i, node in enumerate(nodes):
            code = (1 << i) | (byte >> (8 - i))
            assert level.key[node] == int.from_bytes(bytes([code, *reversed(context)]), "big")
            seen[int(level.key[node])][byte >> (7 - i) & 1] += times
    assert [[int(k), [a, b]] for k, a, b in zip(level.key, level.n0, level.n1)] == [[k, v] for k, v in sorted(seen.items())]


def test_log_gamma():
    x = np.array([0.5, 1.0, 1.5, 7.5, 1000.5, 1e9])
    assert context_tree.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-10, abs=1e-10)


def best_segments(scores):
    """All maximal segments by recursion: the best one, then left and right of it."""
    best = max(((sum(scores[a:b]), -(b - a), -a, a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=None)
    if best is None or best[0] <= 0:
        return []
    _, _, _, a, b = best
    shift = [(x + b, y + b, s) for x, y, s in best_segments(scores[b:])]
    return best_segments(scores[:a]) + [(a, b, best[0])] + shift


def test_maximal_segments():
    rng = random.Random(1)
    for _ in range(200):
        scores = [rng.choice([-1, 1]) * rng.randint(1, 1 << 20) / 1024 for _ in range(rng.randint(0, 14))]
        assert toxicity.segments(scores) == best_segments(scores)


def labelled(n: int):
    """Toxic texts hold some of ten bad stems; bad texts repeat words or shout."""
    rng, rows, labels = random.Random(2), [], []
    bad = [f"zz{c}{c}q" for c in "abcdefghij"]
    for i in range(n):
        words = prose(i, rng.randint(20, 120)).split()
        toxic, good = rng.random() < 0.15, rng.random() < 0.8
        if toxic:
            for _ in range(rng.randint(3, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", "er", "um"]))
        if not good:
            words = [w.upper() + "!!" for w in words] if rng.random() < 0.5 else [w for w in words[:8] for _ in range(10)]
        rows.append((i, " ".join(words), "en", "a", 1))
        labels.append((i, int(good), int(toxic), "x"))
    return rows, labels


@pytest.fixture(scope="module")
def corpus(spark):
    rows, labels = labelled(900)
    docs = frame(spark, rows + [(None, None, None, None, None), (9001, None, "en", "a", 0), (9002, "", "en", "a", 0)])
    return docs, spark.createDataFrame(labels + [(5000, 1, 1, "no document"), (9001, None, None, "x"), (None, 1, 1, "x")], LABELS)


def test_toxicity_of_held_out_rows(spark, corpus):
    docs, labels = corpus
    model = toxicity.train(docs, labels)
    scored = toxicity.score_toxicity(docs, model)
    assert scored.count() == 903 and scored.where("score is null or score < 0 or score > 1").count() == 0
    held_out = scored.join(labels, "doc_id").where(in_fold(F.col("doc_id"), toxicity.FOLDS, toxicity.HELD_OUT)).collect()
    assert len(held_out) > 150
    assert sum(r.predicted == r.toxic for r in held_out) / len(held_out) > 0.95
    one = next(r for r in held_out if r.toxic and r.predicted)
    text = docs.where(docs.doc_id == one.doc_id).first().text
    assert any("zz" in text[p.begin : p.end] for p in one.passages)
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == scored.where("predicted = 0").count()


def test_toxic_passage_after_earlier_uses_of_its_words():
    """Words used twice before, far away, count again; so do later copies of a passage."""
    bad = ["idiot", "moron", "scum", "filth", "vermin"]
    model = toxicity.Model({w: 3.0 for w in bad}, drift=0.5, rate=1.0, k=0.1)
    clean = ["plain"] * 100
    words = [w for x in [*bad, *bad] for w in (x, *clean)] + clean * 20 + bad
    found = [x for x in model.passages(words, {}) if model.expected(x[2], len(words)) <= toxicity.EXPECTED]
    assert [(a, b) for a, b, _ in found] == [(len(words) - 5, len(words))]
    words = (bad + clean) * 4
    assert [(a, b) for a, b, _ in model.passages(words, {})] == [(105 * k, 105 * k + 5) for k in range(4)]
    near = clean + bad * 4 + clean  # one passage with all its copies, two of which count
    assert [(a, b, round(s, 6)) for a, b, s in model.passages(near, {})] == [(100, 120, 25.0)]
    same = ["idiot"] * 500  # repeats alone don't add up
    assert max(s for _, _, s in model.passages(same, {})) <= 5.0


def test_quality_of_held_out_rows(spark, corpus):
    docs, labels = corpus
    scored = quality.score_quality(docs, quality.train(docs, labels))
    assert scored.count() == 903 and scored.where("score is null or score < 0 or score > 1").count() == 0
    held_out = scored.join(labels, "doc_id").where(in_fold(F.col("doc_id"), quality.FOLDS, quality.HELD_OUT)).collect()
    assert len(held_out) > 120
    assert sum(r.predicted == r.quality for r in held_out) / len(held_out) > 0.95


def test_models_without_labels_or_documents(spark, corpus):
    docs, labels = corpus
    none, few = labels.limit(0), docs.limit(0)
    assert {r.score for r in toxicity.score_toxicity(docs.limit(20), toxicity.train(docs, none)).collect()} == {0.0}
    assert {r.score for r in quality.score_quality(docs.limit(20), quality.train(docs, none)).collect()} == {0.0}
    only_good = labels.where("quality = 1")
    assert {r.score for r in quality.score_quality(docs.limit(5), quality.train(docs, only_good)).collect()} == {1.0}
    assert toxicity.score_toxicity(few, toxicity.train(few, labels)).count() == 0
    assert quality.score_quality(few, quality.train(few, labels)).count() == 0


def test_awkward_texts_are_scored(spark, corpus):
    docs, labels = frame(spark, awkward()), corpus[1]
    assert toxicity.score_toxicity(docs, toxicity.train(*corpus)).where("score between 0 and 1").count() == len(awkward())
    assert quality.score_quality(docs, quality.train(*corpus)).where("score between 0 and 1").count() == len(awkward())
    assert labels.count()


def test_a_pass_lets_go_of_tables_of_an_earlier_one():
    from ledgerloom.llm.common import Sent

    Sent._derived["earlier"] = ("name", b"table")
    Sent.release()
    assert not Sent._derived
