"""Dense surrogate keys without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Hex digits of the hash prefix, and the most that keep the broadcast offset table
# (16**digits + 1 rows of about 50 bytes) small at any data size.
PREFIX_LENGTH, MOST_DIGITS = 3, 4


def assign_keys(
    df: DataFrame, id_column: str, key_column: str, taken: DataFrame | int | None = None,
    prefix_length: int = PREFIX_LENGTH,
) -> DataFrame:
    """Number rows ``max(taken) + 1, ...`` in the order of ``(md5(id), id)``.

    Ids must be unique and not NULL. The hash prefix spreads rows evenly over
    ``16**prefix_length`` groups, which is also the most tasks that number them (4,096 by
    default, 65,536 at most); the keys are the same for any length. Each is numbered on its own and shifted by the size of the groups
    before it. The number of a row depends on the ids alone, so a lost and
    recomputed task hands out the same keys. ``taken`` is a frame whose
    ``key_column`` holds the keys in use; empty or None starts at 1.
    """
    if not 1 <= prefix_length <= MOST_DIGITS:
        raise ValueError(f"prefix_length must be between 1 and {MOST_DIGITS}: its offset table is broadcast")
    spread = df.withColumn("_hash", F.md5(F.col(id_column).cast("binary"))).withColumn(
        "_prefix", F.substring("_hash", 1, prefix_length)
    )
    sizes = spread.groupBy("_prefix").agg(F.count(F.lit(1)).alias("_size"))
    if taken is not None:
        # The empty prefix sorts before all others and carries the highest key in use.
        if isinstance(taken, int):
            used = df.sparkSession.range(1).select(F.lit(taken).cast("bigint").alias("_size"))
        else:
            used = taken.agg(F.coalesce(F.max(key_column), F.lit(0)).cast("bigint").alias("_size"))
        sizes = used.select(F.lit("").alias("_prefix"), "_size").unionByName(sizes)
    before = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_prefix"), F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    within = Window.partitionBy("_prefix").orderBy("_hash", id_column)
    return (
        spread.withColumn("_number", F.row_number().over(within))
        .join(F.broadcast(offsets), "_prefix")
        .withColumn(key_column, (F.col("_offset") + F.col("_number")).cast("bigint"))
        .drop("_hash", "_prefix", "_offset", "_number")
    )
