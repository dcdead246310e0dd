"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled rows of quality 1, the unlabelled set is a sample of the web
text itself whose labels are not looked at. With the class prior pi, the share of good texts,
the risk of calling text bad is estimated as risk(unlabelled) - pi * risk(positives); that
difference can't be negative for a true risk, so wherever a batch makes it negative its
gradient is turned round (the non-negative unbiased estimator). The model is a small network
on features of form: lengths, repetition, capitals, symbols, layout. The prior is
estimated by the share of quality 1 among the labelled training rows.

Fitted on bounded samples by hash order: at most ``POSITIVES`` labelled rows and about
``UNLABELLED`` others, of which only feature vectors reach the driver. Scoring covers every whole text.

Defined results: null and empty texts have the features of no words and get a score like any
other. Rows with the same doc_id are scored one by one. Null labels, and labels without a
document, don't count. Without positives, or without any other label to estimate the prior,
every score is the share of good labels (0 without labels). Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import in_fold

POSITIVES, UNLABELLED = 8_000, 16_000
FOLDS, HELD_OUT, THRESHOLD = 5, 0, 0.3
HIDDEN, ROUNDS, BATCH, RATE, DECAY, SEED = 24, 2_500, 1_024, 4e-3, 1e-4, 7

_CLASSES = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "bar": b"|", "bang": b"!?", "stop": b".,;:",
    "symbol": b"#$%&*@^~_=+<>\\/{}[]", "quote": b"'\"()-", "line": b"\n", "space": b" \t\r\x0b\x0c", "other": range(128, 256),
}
_MASK = np.zeros((len(_CLASSES), 256))
for _k, _codes in enumerate(_CLASSES.values()):
    _MASK[_k, list(_codes)] = 1.0
N_FEATURES = len(_CLASSES) + 12


def features(text: bytes) -> np.ndarray:
    """Shares of character classes and of repeated words, pairs and lines; sizes as logarithms."""
    size = max(len(text), 1)
    classes = _MASK @ np.bincount(np.frombuffer(text, np.uint8), minlength=256) / size
    words = text.split()
    n = max(len(words), 1)
    counts = Counter(words)
    lines = text.split(b"\n")
    pairs = len(set(zip(words, words[1:])))
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    capitals = sum(1 for w in words if w[:1].isupper())
    top = counts.most_common(3)
    return np.array([
        *classes, np.log1p(len(words)), np.log1p(len(lines)), len(counts) / n, max(counts.values(), default=0) / n,
        sum(k for _, k in top) / n, sum(map(bytes.__eq__, words, words[1:])) / n, pairs / n, len(set(lines)) / len(lines),
        np.log1p(lengths.mean()), np.log1p(lengths.max()), capitals / n, np.log1p(n / len(lines)),
    ])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    base: float | None = None  # the score when nothing could be learnt

    def logit(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.weights
        return np.tanh((x - self.mean) / self.scale @ a + b) @ c + d

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.base is not None:
            return np.full(len(x), self.base)
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> Model:
    """Minimise the non-negative risk with logistic loss by Adam."""
    rng = np.random.default_rng(SEED)
    whole = np.concatenate([positive, unlabelled])
    mean, scale = whole.mean(0), whole.std(0) + 1e-6
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    w = [rng.normal(0, 1 / np.sqrt(N_FEATURES), (N_FEATURES, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.1, HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(x) for x in w], [np.zeros_like(x) for x in w]
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, ROUNDS + 1):
        x = np.concatenate([p[rng.integers(0, len(p), BATCH)], u[rng.integers(0, len(u), BATCH)]])
        h = np.tanh(x @ w[0] + w[1])
        z = h @ w[2] + w[3]
        zp, zu = z[:BATCH], z[BATCH:]
        loss = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        slope = np.concatenate([-prior * sigmoid(zp), sigmoid(zu)]) / BATCH  # of that difference, positives subtracted
        if loss < 0:
            slope = -slope
        else:
            slope[:BATCH] -= prior * sigmoid(-zp) / BATCH
        back = slope[:, None] * w[2] * (1 - h * h)
        grads = [x.T @ back + DECAY * w[0], back.sum(0), h.T @ slope + DECAY * w[2], np.array([slope.sum()])]
        rate = RATE * (1 - step / (ROUNDS + 1))
        for k, g in enumerate(grads):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            w[k] = w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, w)


def _vectors(batch: pa.RecordBatch) -> np.ndarray:
    rows = [features(t or b"") for t in batch.column("text").to_pylist()]
    return np.array(rows) if rows else np.zeros((0, N_FEATURES))


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Fit on labelled positives and unlabelled text, both outside the held-out fold."""
    usable = labels.where("quality is not null and doc_id is not null").where(~in_fold(F.col("doc_id"), FOLDS, HELD_OUT))
    n, good = usable.agg(F.count("*"), F.coalesce(F.sum(F.when(F.col("quality") != 0, 1).otherwise(0)), F.lit(0))).first()
    if not good or good == n:
        return Model(np.zeros(1), np.ones(1), [], base=good / n if n else 0.0)
    chosen = usable.where("quality != 0").select("doc_id", F.lit(True).alias("trusted")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(positives)
    steps = 1 << 30
    share = min(steps, steps * unlabelled // max(docs.count(), 1))
    drawn = (F.pmod(F.xxhash64("doc_id", F.lit("unlabelled")), F.lit(steps)) < share) & ~in_fold(F.col("doc_id"), FOLDS, HELD_OUT)
    rows = docs.select("doc_id", F.col("text").cast("binary"), drawn.alias("drawn")).join(F.broadcast(chosen), "doc_id", "left")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [v.tolist() for v in _vectors(batch)]
            yield pa.RecordBatch.from_pydict({
                "trusted": batch.column("trusted"), "drawn": batch.column("drawn"), "x": pa.array(x, pa.list_(pa.float64()))})

    picked = rows.where("drawn or trusted").select("trusted", "drawn", "text")
    found = picked.mapInArrow(measure, "trusted boolean, drawn boolean, x array<double>").toArrow()
    if not found.num_rows:
        return Model(np.zeros(1), np.ones(1), [], base=good / n)
    x = np.array(found.column("x").to_pylist())
    trusted = np.array([bool(t) for t in found.column("trusted").to_pylist()])
    other = np.array(found.column("drawn").to_pylist())
    if not trusted.any() or not other.any():
        return Model(np.zeros(1), np.ones(1), [], base=good / n)
    return fit(x[trusted], x[other], good / n)


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, score, predicted."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = sent.value.score(_vectors(batch))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "score": pa.array(s, pa.float64()), "predicted": pa.array((s >= THRESHOLD).astype(np.int32))})

    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(score, f"doc_id {kind}, score double, predicted int")
