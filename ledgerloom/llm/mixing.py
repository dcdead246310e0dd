"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is (its target share x size of the mix) / its rows. Each row
draws a uniform number from a digest of (seed, id, text) and takes the Poisson count
at which the inverse distribution reaches it; it is exploded by that count and all copies are
shuffled globally by a digest of their own. So a row's count depends on nothing but itself,
the seed and the rate, and a retried task draws the same.

Only SQL functions are used. The rates are one row per source, joined back; a source that
holds a third of all rows is counted within tasks first and its rows are never grouped.

Defined results: a null source is a source of its own. Sources without a weight get weight 1;
weights that aren't positive leave their source out. Rows with the same id and text are drawn
alike, one by one. Null texts and ids draw as empty ones. An empty table gives an empty mix.
Columns named like the added ones are replaced by them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import saved

SEED = 20_240
#: exp(-rate) stays far from zero up to here; larger rates are sums of several equal draws.
MOST_RATE = 500.0
ADDED = ("rate", "copies", "copy_no", "position")


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from the first 13 hex digits of a digest."""
    digest = F.md5(F.concat_ws("|", *(F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in parts)))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def poisson(u: Column, rate: Column) -> Column:
    """The smallest k whose cumulative probability is over u: the inverse distribution."""
    def steps(u: Column) -> Column:
        start = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("c"), F.lit(0).alias("k"))
        terms = F.sequence(F.lit(1), (rate + 12 * F.sqrt(rate) + 30).cast("int"))
        return F.aggregate(terms, start, lambda s, i: F.struct(
            (s["p"] * rate / i).alias("p"), (s["c"] + s["p"] * rate / i).alias("c"),
            F.when(u >= s["c"], i).otherwise(s["k"]).alias("k")), lambda s: s["k"])

    return F.transform(F.array(u), steps)[0]  # u is bound once, not computed at every step


def rates(docs: DataFrame, weights: dict[str | None, float], size: float | None = None) -> DataFrame:
    """source (as __source) and its mean repetition rate for a mix of about ``size`` rows (default: as many as there are).

    Written to the shared folder, so that Spark sees its true size when it picks the join.
    """
    weight = F.lit(1.0)
    for source, w in weights.items():
        weight = F.when(F.col("source").eqNullSafe(F.lit(source)), F.lit(float(w))).otherwise(weight)
    counts = saved(docs.groupBy("source").agg(F.count("*").alias("n")).withColumn("w", F.greatest(weight, F.lit(0.0))), "rates")
    rows, total = counts.agg(F.sum("n"), F.sum("w")).first()
    factor = (float(rows or 0) if size is None else float(size)) / total if total else 0.0
    return counts.select(F.col("source").alias("__source"), (F.col("w") * F.lit(factor) / F.col("n")).alias("rate"))


def mix(docs: DataFrame, weights: dict[str | None, float], size: float | None = None, seed: int = SEED) -> DataFrame:
    """Every copy of every row, with rate, copies, copy_no (from 1) and position, in order of position.

    The order is global: ranges of positions of about equal size, each sorted.
    """
    kept = docs.drop(*ADDED)
    rated = kept.join(rates(docs, weights, size), F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    key = (F.col("doc_id").cast("string"), "text")
    draws = F.ceil(F.greatest(F.col("rate") / MOST_RATE, F.lit(1.0))).cast("int")
    draw = lambda i: poisson(uniform(F.lit(f"{seed}"), i.cast("string"), *key), F.col("rate") / draws)
    copies = F.aggregate(F.sequence(F.lit(1), draws), F.lit(0), lambda n, i: n + draw(i))
    drawn = rated.withColumn("copies", copies).where("copies > 0")
    exploded = drawn.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    placed = exploded.withColumn("position", uniform(F.lit(f"{seed} place"), F.col("copy_no").cast("string"), *key))
    return placed.repartitionByRange("position").sortWithinPartitions("position", "doc_id", "copy_no")
