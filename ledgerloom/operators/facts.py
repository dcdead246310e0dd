"""Surrogate-key lookup, incremental filter and fact projection."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.conform import conform, lineage
from ledgerloom.schemas import FINANCIAL_FACT

FACT_KEYS = ("company_id", "period_type", "source_file")
#: Positions in the bitmaps of a key summary, for each folder and source file.
KEY_POSITIONS = 1 << 20


def resolve_keys(staged: DataFrame, current_dimension: DataFrame) -> DataFrame:
    """Attach ``dim_company_sk`` of the current version; NULL when the company is unknown.

    No broadcast hint: the dimension grows, so Spark decides by its size. When both
    sides are shuffled, adaptive execution splits a hot company on the staged side,
    which a left join allows because the dimension holds one row per company.
    """
    lookup = current_dimension.select("company_id", "dim_company_sk")
    return staged.join(lookup, "company_id", "left")


def incremental(
    new: DataFrame,
    existing: DataFrame,
    keys: Sequence[str] = FACT_KEYS,
    null_safe: bool = False,
    scope: str | None = None,
) -> DataFrame:
    """Rows whose key is not among the ``existing`` ones.

    With plain keys a NULL never equals a NULL, so such a row always counts as new;
    ``null_safe`` treats NULLs as equal. Existing keys are made unique first, which
    shrinks copies within each task before the shuffle. ``scope`` names a key; existing
    rows whose scope is not in this batch are dropped first, so a load of new files
    does not shuffle the keys of the whole fact table. It reads ``new`` twice: use it
    where ``new`` is a stored table.
    """
    stored = existing.select(*keys)
    if scope is not None:
        scopes = new.select(F.col(scope).alias("_scope")).distinct()
        match = _equal(F.col(scope), F.col("_scope"), null_safe)
        stored = stored.join(scopes, match, "left_semi")
    stored = stored.distinct().select(*(F.col(k).alias(f"_{k}") for k in keys))
    on = reduce(
        lambda a, b: a & b, (_equal(F.col(k), F.col(f"_{k}"), null_safe) for k in keys)
    )
    return new.join(stored, on, "left_anti")


def key_summary(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Which keys the rows of each folder (``by``) may hold: per source file, bitmaps of hashed keys.

    Columns: those of ``by``, source_file, bucket, bits. A bucket covers 32,768 of ``KEY_POSITIONS`` positions, so
    a folder has at most 32 rows of 4 KB for each file, however many facts it holds.
    """
    place = F.pmod(F.xxhash64("company_id", "period_type"), F.lit(KEY_POSITIONS)) + 1
    return rows.groupBy(*by, "source_file", F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))


def folders_with_keys(new: DataFrame, stored: DataFrame, by: Sequence[str], scope: Sequence[str] = (), null_safe: bool = False) -> DataFrame:
    """Folders (``by``) of the ``stored`` summaries that may hold a key of the rows ``new``; others can't.

    ``scope`` names columns that both sides have and that must be equal. The two bitmaps of a file are laid
    over each other: the join is one of summaries, never of keys.
    """
    wanted = new if null_safe else new.where(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in FACT_KEYS)))
    own = key_summary(wanted, scope).select(*(F.col(c).alias(f"_{c}") for c in (*scope, "source_file", "bucket", "bits")))
    match = reduce(
        lambda a, b: a & b, [_equal(F.col("source_file"), F.col("_source_file"), null_safe), F.col("bucket") == F.col("_bucket"),
                             *(F.col(c) == F.col(f"_{c}") for c in scope)])
    both = stored.join(own, match).select(*by, "source_file", "bucket", F.explode(F.array("bits", "_bits")).alias("bits"))
    common = both.groupBy(*by, "source_file", "bucket").agg(F.bitmap_count(F.bitmap_and_agg("bits")).alias("common"))
    return common.where("common > 0").select(*by).distinct()


def _equal(left: Column, right: Column, null_safe: bool) -> Column:
    return left.eqNullSafe(right) if null_safe else left == right


def project_fact(
    resolved: DataFrame, batch_id: str, as_of: Column | None = None, kept: Sequence[str] = ()
) -> DataFrame:
    """The fact columns, and after them those named in ``kept``, as they are."""
    schema = T.StructType([*FINANCIAL_FACT, *(resolved.schema[name] for name in kept)])
    return conform(resolved, schema, constants=lineage(batch_id, as_of))


def new_facts(
    staged: DataFrame, current_dimension: DataFrame, existing: DataFrame | None,
    batch_id: str, as_of: Column | None = None, null_safe: bool = False, scope: str | None = None,
    kept: Sequence[str] = (),
) -> DataFrame:
    """Staged rows to append to the fact table.

    Known rows are dropped before the key lookup: the lookup neither adds nor drops
    rows, so the result is the same and the larger join handles new rows only.
    """
    fresh = staged if existing is None else incremental(
        staged, existing, null_safe=null_safe, scope=scope
    )
    return project_fact(resolve_keys(fresh, current_dimension), batch_id, as_of, kept)


def resolution_counts(facts: DataFrame) -> DataFrame:
    """One row: all facts, those with and those without a surrogate key."""
    known = F.col("dim_company_sk").isNotNull()
    return facts.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(known).alias("resolved"),
        F.count_if(~known).alias("unresolved"),
    )


def period_distribution(facts: DataFrame) -> DataFrame:
    return facts.groupBy("period_type").agg(F.count(F.lit(1)).alias("cnt")).orderBy("period_type")
