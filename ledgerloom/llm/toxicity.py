"""Toxicity: maximum-scoring segments of token log-odds, calibrated by extreme values.

Tokens are the words of the text in lower case (A-Z). The log-odds of a word are those of
its rows being toxic against those of all rows, under Dirichlet priors of ``PRIOR`` rows:
that of a word is centred on its stem (first ``STEMS`` letters), that of a stem on a
shorter one, and at the top on the share of toxic rows. So rare and unseen words take after
their stems and a word with little evidence stays near zero.

Each word of a text scores its log-odds less a drift that makes the expected score of clean
text negative; of a word that goes on repeating, ``REPEATS`` occurrences within ``GAP`` words
count. A linear scan finds every maximal positive-scoring segment, which then goes on over
copies of itself that didn't count. For clean text the
best segment follows an extreme-value law: P(S >= x) = 1 - exp(-K n exp(-lambda x)) for n
words. lambda solves the Karlin-Altschul equation over the scores of clean training words, K
is fitted to the best segments of clean training documents. Segments with an expected count
of at most ``EXPECTED`` are significant passages. A logistic curve over the extreme-value
evidence of the significant passages, fitted to the training rows, gives the score.

Only the model is fitted on a bounded sample: at most ``TRAIN_ROWS`` labelled rows by hash
order, two thirds of them for the log-odds, the rest for the calibration. The word table then
holds at most the words of these rows and is broadcast. Scoring covers every whole text.

Defined results: null and empty texts have no passage and the score of no evidence. Rows
with the same doc_id are scored one by one. Labels that are null, or whose document is
missing, don't count; a repeated label row counts as often as it occurs. Without both
classes among the labels every score is the share of toxic labels (0 without any). Other
columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import fold, in_fold, saved, strings

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Labelled rows that the model is fitted on, at most.
TRAIN_ROWS = 24_000
FOLDS, HELD_OUT = 4, 2
#: Letters of the stems, shorter ones last; weight of a prior in rows; least drift;
#: expected count of a significant segment; threshold of the score; rows that a word needs;
#: occurrences of a word that count within so many words.
STEMS, PRIOR, DRIFT, EXPECTED, THRESHOLD, SEEN, REPEATS, GAP = (5, 4), 8.0, 0.25, 0.05, 0.3, 3, 2, 50


def stems(word: str) -> list[str]:
    """The word's stems, the longest first; marked by a character that no word has."""
    return [f".{word[:k]}" for k in STEMS if len(word) >= k] if len(word) > 3 else []


def features(text: str) -> list[str]:
    """Words and stems of a text, one of each."""
    words = set(WORD.findall(fold(text)))
    return [*words, *{s for w in words for s in stems(w)}]


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) by the linear-time stack method."""
    found: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum at the end
    total = 0.0
    for at, score in enumerate(scores):
        before, total = total, total + score
        if score <= 0:
            continue
        start, low, end = at, before, at + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= low:
                j -= 1
            if j < 0 or found[j][3] >= total:
                break
            start, low = found[j][0], found[j][2]
            del found[j:]
        found.append((start, end, low, total))
    return [(a, b, high - low) for a, b, low, high in found]


@dataclass
class Model:
    odds: dict[str, float]
    drift: float = DRIFT
    rate: float = 1.0  # lambda
    k: float = 1.0
    slope: float = 1.0
    offset: float = 0.0
    base: float | None = None  # the score when nothing could be learnt

    def word(self, word: str) -> float:
        """Log-odds of a word, else of its longest known stem, else zero."""
        return next((x for f in (word, *stems(word)) if (x := self.odds.get(f)) is not None), 0.0)

    def passages(self, words: list[str], cache: dict[str, float]) -> list[tuple[int, int, float]]:
        """Segments of words with their scores; runs of negative words count as one step."""
        steps, at, debt = [], [], 0.0
        counted: dict[str, list[int]] = {}  # places of the last REPEATS occurrences that count
        raw, repeats = [], False
        for i, w in enumerate(words):
            s = cache.get(w)
            if s is None:
                if len(cache) > 300_000:
                    cache.clear()
                s = cache[w] = self.word(w) - self.drift
            raw.append(s)
            if s > 0:  # a word that goes on repeating nearby is no new evidence
                places = counted.setdefault(w, [])
                if len(places) == REPEATS and i - places[0] <= GAP:
                    s, repeats = -self.drift, True
                else:
                    places.append(i)
                    del places[:-REPEATS]
            if s <= 0:
                debt += s
                continue
            if debt:
                steps.append(debt)
                at.append(i)
                debt = 0.0
            steps.append(s)
            at.append(i)
        found = [(at[a], at[b - 1] + 1, s) for a, b, s in segments(steps)]
        return self._extended(found, raw) if repeats else found

    def _extended(self, found: list[tuple[int, int, float]], raw: list[float]) -> list[tuple[int, int, float]]:
        """Segments up to where the uncounted repeats after them end, at most up to the next one; scores stay."""
        out = []
        for (a, b, s), limit in zip(found, [*(x[0] for x in found[1:]), len(raw)]):
            run, best, end = 0.0, 0.0, b
            for i in range(b, limit):
                run += raw[i]
                if run > best:
                    best, end = run, i + 1
                elif run < best - s:
                    break
            out.append((a, end, s))
        return out

    def expected(self, score: float, n: int) -> float:
        """Segments of this score that clean text of n words would have."""
        return self.k * n * math.exp(max(-700.0, -self.rate * score))

    def evidence(self, scores: list[float], n: int) -> float:
        """Extreme-value evidence: -log of the expected counts, summed over significant passages."""
        logs = [-math.log(max(self.expected(s, n), 1e-300)) for s in scores]
        significant = [x for x in logs if x >= -math.log(EXPECTED)]
        return min(sum(significant) if significant else max([*logs, -5.0]), 60.0)

    def score(self, evidence: float) -> float:
        if self.base is not None:
            return self.base
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, self.slope * evidence + self.offset))))


def _background_rate(scores: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of sum p exp(lambda s) = 1; scores with a negative mean and a positive one."""
    p = counts / counts.sum()
    if (p * scores).sum() >= 0 or scores.max() <= 0:
        return 1.0
    low, high = 0.0, 1.0
    with np.errstate(over="ignore"):
        while (p * np.exp(high * scores)).sum() < 1 and high < 64:
            high *= 2
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if (p * np.exp(middle * scores)).sum() < 1 else (low, middle)
    return max(high, 1e-3)


def fit_odds(counts: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> Model:
    """Log-odds of words and stems, the drift, and lambda; counts: (feature, toxic rows, clean rows)."""
    by = {f: (t, c) for f, t, c in counts}
    base = n_toxic / (n_toxic + n_clean)
    shares: dict[str, float] = {}

    def share(chain: list[str]) -> float:
        """Share of toxic rows among those with the feature, under a Dirichlet prior centred on the next of the chain."""
        if not chain:
            return base
        if chain[0] not in shares:
            t, c = by.get(chain[0], (0, 0))
            shares[chain[0]] = (t + PRIOR * share(chain[1:])) / (t + c + PRIOR)
        return shares[chain[0]]

    odds = {}
    for f in by:
        q = share([f".{f[1:k + 1]}" for k in STEMS if k < len(f)] if f[0] == "." else [f, *stems(f)])
        odds[f] = math.log(q / (1 - q)) - math.log(base / (1 - base))
    words = [f for f in by if f[0] != "."]
    x = np.array([odds[f] for f in words] or [0.0])
    p = np.array([by[f][1] for f in words] or [1], dtype=float)
    p /= max(p.sum(), 1.0)
    mean = float((p * x).sum())
    model = Model(odds)
    model.drift = max(DRIFT, mean + math.sqrt(float((p * (x - mean) ** 2).sum())))
    model.rate = _background_rate(x - model.drift, p)
    model.odds = {f: o for f, o in odds.items() if f[0] == "." or abs(o - _stem_odds(f, odds)) > 0.02}
    return model


def _stem_odds(word: str, odds: dict[str, float]) -> float:
    return next((odds[s] for s in stems(word) if s in odds), 0.0)


def calibrate(model: Model, rows: list[tuple[int, int, list[float]]]) -> None:
    """Fit K and the logistic curve; rows: (toxic, number of words, scores of the segments)."""
    clean = [(n, max(s, default=0.0)) for toxic, n, s in rows if not toxic and n]
    if clean:
        model.k = len(clean) / sum(n * math.exp(-model.rate * s) for n, s in clean)
    x = np.array([model.evidence(s, n) for _, n, s in rows])
    y = np.array([float(t) for t, _, _ in rows])
    if not 0 < y.sum() < len(y):
        model.base = float(y.mean()) if len(y) else 0.0
        return
    w = np.array([0.1, math.log(y.mean() / (1 - y.mean()))])
    for _ in range(50):  # Newton, with a small penalty that keeps separable classes finite
        z = np.clip(w[0] * x + w[1], -30, 30)
        q = 1 / (1 + np.exp(-z))
        g = np.array([((q - y) * x).sum() + 0.5 * w[0], (q - y).sum() + 0.05 * w[1]])
        v = q * (1 - q)
        h = np.array([[(v * x * x).sum() + 0.5, (v * x).sum()], [(v * x).sum(), v.sum() + 0.05]])
        move = np.clip(np.linalg.solve(h, g), -1, 1)
        w -= move
        if abs(move).max() < 1e-6:
            break
    model.slope, model.offset = float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Fit the model on labelled rows outside the held-out fold."""
    spark = docs.sparkSession
    usable = labels.where("toxic is not null and doc_id is not null").where(~in_fold(F.col("doc_id"), FOLDS, HELD_OUT))
    chosen = usable.select("doc_id", F.col("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    third = F.pmod(F.xxhash64("doc_id", F.lit("calibrate")), F.lit(3)) == 0
    rows = saved(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select(
        F.coalesce("text", F.lit("")).alias("text"), F.when(F.col("toxic") != 0, 1).otherwise(0).alias("toxic"), third.alias("calibrates")), "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, toxic in zip(strings(batch.column("text")), batch.column("toxic").to_pylist()):
                seen[toxic].update(features(text))
        for toxic, counter in seen.items():
            yield pa.RecordBatch.from_pydict({
                "feature": pa.array(list(counter), pa.string()), "toxic": pa.array([toxic] * len(counter), pa.int32()),
                "n": pa.array(list(counter.values()), pa.int64())})

    fits = rows.where("not calibrates")
    size = {r.toxic: r["count"] for r in fits.groupBy("toxic").count().collect()}
    counts = fits.mapInArrow(count, "feature string, toxic int, n long").groupBy("feature").agg(
        F.sum(F.expr("if(toxic = 1, n, 0)")).alias("t"), F.sum(F.expr("if(toxic = 0, n, 0)")).alias("c"))
    # Bounded: the words of at most train_rows texts.
    table = [(r.feature, r.t, r.c) for r in counts.where(F.col("t") + F.col("c") >= SEEN).toLocalIterator()]
    n_toxic, n_clean = size.get(1, 0), size.get(0, 0)
    if not n_toxic or not n_clean:
        return Model({}, base=float(n_toxic > 0))
    model = fit_odds(table, n_toxic, n_clean)
    shared = spark.sparkContext.broadcast(model)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, float] = {}
        for batch in batches:
            words = [WORD.findall(fold(t)) for t in strings(batch.column("text"))]
            yield pa.RecordBatch.from_pydict({
                "toxic": batch.column("toxic"), "n": pa.array([len(w) for w in words], pa.int64()),
                "s": pa.array([[s for _, _, s in shared.value.passages(w, cache)] for w in words], pa.list_(pa.float64()))})

    scored = rows.where("calibrates").mapInArrow(best, "toxic int, n long, s array<double>")
    calibrate(model, [(r.toxic, r.n, r.s) for r in scored.toLocalIterator()])
    return model


def _scorer(model: Broadcast, keep: Callable) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, cache = model.value, {}
        for batch in batches:
            scores, found = [], []
            for text in strings(batch.column("text")):
                folded = fold(text)
                words = WORD.findall(folded)
                segs = m.passages(words, cache)
                scores.append(m.score(m.evidence([s for _, _, s in segs], len(words))))
                real = [x for x in segs if m.expected(x[2], len(words)) <= EXPECTED]
                at = [x.span() for x in WORD.finditer(folded)] if real else []
                found.append([{"begin": at[a][0], "end": at[b - 1][1], "score": s} for a, b, s in real])
            yield keep(batch, scores, found)

    return score


_PASSAGES = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, score, predicted, passages (character offsets and segment scores)."""

    def rows(batch: pa.RecordBatch, scores: list[float], found: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "score": pa.array(scores, pa.float64()),
            "predicted": pa.array([int(s >= THRESHOLD) for s in scores], pa.int32()), "passages": pa.array(found, _PASSAGES)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select("doc_id", "text").mapInArrow(
        _scorer(shared, rows), f"doc_id {kind}, score double, predicted int, passages array<struct<begin:int,end:int,score:double>>")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that aren't predicted toxic, with all their columns."""

    def rows(batch: pa.RecordBatch, scores: list[float], found: list) -> pa.RecordBatch:
        return batch.filter(pa.array([s < THRESHOLD for s in scores], pa.bool_()))

    return docs.mapInArrow(_scorer(docs.sparkSession.sparkContext.broadcast(model), rows), docs.schema)
