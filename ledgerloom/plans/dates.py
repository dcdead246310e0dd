"""Generated date dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The seeded span.
FIRST_DAY, LAST_DAY = "2019-01-01", "2025-12-31"


def _calendar(bounds: DataFrame) -> DataFrame:
    """One row per day between the ``first`` and ``last`` of a one-row frame, both included."""
    days = bounds.select(
        F.col("first"),
        F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("full_date"),
    )
    day = F.col("full_date")
    weekday: Column = F.dayofweek(day) - 1
    return days.select(
        (F.datediff(day, F.col("first")) + 1).alias("dim_date_sk"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.rpad(F.date_format(day, "MMMM"), 9, " ").alias("month_name"),
        weekday.alias("day_of_week"),
        weekday.isin(0, 6).alias("is_weekend"),
    )


def date_dimension(spark: SparkSession, first: str = FIRST_DAY, last: str = LAST_DAY) -> DataFrame:
    """Sunday is day 0; month names are padded to nine characters."""
    bounds = spark.range(1).select(
        F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last")
    )
    return _calendar(bounds)


def date_dimension_of(df: DataFrame, moment: str) -> DataFrame:
    """The date dimension over the span of a date or timestamp column."""
    day = F.col(moment).cast("date")
    return _calendar(df.agg(F.min(day).alias("first"), F.max(day).alias("last")))
