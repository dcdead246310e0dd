"""Type-2 company dimension: every name change keeps the old version.

A version is open (``is_current``) from ``valid_from`` until a change closes it at
the moment the next one opens. Closed versions never change again, so a load
only has to touch the current slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.conform import conform, stack
from ledgerloom.operators.keys import assign_keys
from ledgerloom.operators.quality import keep_identified, remove_duplicates
from ledgerloom.schemas import COMPANY_DIMENSION

# Fixed value: end of an open version.
OPEN_END = "9999-12-31 00:00:00"

NEW, UPDATE, UNCHANGED = "new", "update", "unchanged"


def current(dimension: DataFrame) -> DataFrame:
    return dimension.where("is_current")


def company_input(frames: list[DataFrame]) -> DataFrame:
    """Company rows of several sources, one per id; an earlier source wins."""
    ranked = [
        keep_identified(f.select("company_id", "company_name")).withColumn("_source", F.lit(i))
        for i, f in enumerate(frames)
    ]
    return remove_duplicates(
        stack(ranked), ["company_id"], order_by=["_source", "company_name"]
    ).drop("_source")


def classify(current_rows: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming companies with their action and, where known, the version they meet.

    A NULL incoming name is never a change; a stored NULL replaced by a name is.
    Both sides hold one row per id, so no key can be hot.
    """
    fresh = remove_duplicates(
        keep_identified(incoming.select("company_id", F.col("company_name").alias("new_name"))),
        ["company_id"],
    )
    known = current_rows.select(
        "company_id", F.struct(*(f.name for f in COMPANY_DIMENSION)).alias("version")
    )
    old_name = F.col("version.company_name")
    changed = F.col("new_name").isNotNull() & ~old_name.eqNullSafe(F.col("new_name"))
    return fresh.join(known, "company_id", "left").withColumn(
        "action",
        F.when(F.col("version").isNull(), NEW).when(changed, UPDATE).otherwise(UNCHANGED),
    )


def changes(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("action").isin(NEW, UPDATE))


def stats(classified: DataFrame) -> DataFrame:
    """One row: new_inserts, updates, unchanged."""
    return classified.agg(
        F.count_if(F.col("action") == NEW).alias("new_inserts"),
        F.count_if(F.col("action") == UPDATE).alias("updates"),
        F.count_if(F.col("action") == UNCHANGED).alias("unchanged"),
    )


def closed_versions(changed: DataFrame, now: Column) -> DataFrame:
    """The versions an update ends, closed at ``now``."""
    ended = changed.where(F.col("action") == UPDATE).select("version.*")
    return conform(
        ended, COMPANY_DIMENSION,
        constants={"valid_to": now, "is_current": F.lit(False), "updated_at": now},
    )


def opened_versions(changed: DataFrame, now: Column, taken: DataFrame | int | None = None) -> DataFrame:
    """One open version per new or updated company, with fresh surrogate keys."""
    opened = changed.select("company_id", F.col("new_name").alias("company_name"))
    keyed = assign_keys(opened, "company_id", "dim_company_sk", taken)
    return conform(
        keyed, COMPANY_DIMENSION,
        constants={
            "valid_from": now, "valid_to": F.lit(OPEN_END).cast("timestamp"),
            "is_current": F.lit(True), "created_at": now, "updated_at": now,
        },
    )


def untouched(current_rows: DataFrame, changed: DataFrame) -> DataFrame:
    """Current versions that stay as they are, companies absent from the input included."""
    ended = changed.where(F.col("action") == UPDATE).select("company_id")
    return conform(current_rows.join(ended, "company_id", "left_anti"), COMPANY_DIMENSION)


def apply_scd2(dimension: DataFrame, incoming: DataFrame, now: Column) -> DataFrame:
    """The whole next dimension as one plan.

    The batch runner writes the same parts separately, so history is never rewritten.
    """
    open_rows = current(dimension)
    changed = changes(classify(open_rows, incoming))
    return stack([
        conform(dimension.where("not is_current"), COMPANY_DIMENSION),
        untouched(open_rows, changed),
        closed_versions(changed, now),
        opened_versions(changed, now, taken=dimension),
    ])


def as_of(facts: DataFrame, dimension: DataFrame, moment: str) -> DataFrame:
    """Each fact with the company name valid at its ``moment`` column; NULL before the first.

    The id stays an equality key, so the time range is only compared among the few
    versions of one company, and adaptive execution can split a company whose facts
    fill a partition (the fact side of a left join is splittable).
    """
    versions = dimension.select(
        F.col("company_id").alias("_id"), F.col("dim_company_sk").alias("version_sk"),
        F.col("company_name").alias("name_at_time"), "valid_from", "valid_to",
    )
    at = F.col(moment).cast("timestamp")
    holds = (at >= F.col("valid_from")) & (at < F.col("valid_to"))
    return facts.join(versions, (F.col("company_id") == F.col("_id")) & holds, "left").drop(
        "_id", "valid_from", "valid_to"
    )


def version_counts(dimension: DataFrame) -> DataFrame:
    return dimension.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("is_current")).alias("current")
    )
