"""Bring frames to one declared schema and stack them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import to_int, to_money
from ledgerloom.schemas import STAGED_COMPANIES, STAGED_FINANCIALS


def typed(column: Column, have: T.DataType, want: T.DataType) -> Column:
    """``column`` of type ``have`` as ``want``; values that do not fit the type become NULL."""
    if have == want:
        return column
    if isinstance(want, T.IntegerType):
        return to_int(column, have)
    if isinstance(want, T.DecimalType):
        return to_money(column)
    return column.try_cast(want)


def conform(
    df: DataFrame,
    schema: T.StructType,
    defaults: Mapping[str, object] | None = None,
    constants: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Exactly the columns of ``schema``, in its order, cast to its types.

    A missing column becomes its default or a typed NULL. ``constants`` (lineage
    columns) replace whatever the frame holds under that name. One projection.
    """
    defaults, constants = defaults or {}, constants or {}
    have = {field.name: field.dataType for field in df.schema}

    def column(field: T.StructField) -> Column:
        if field.name in constants:
            return constants[field.name].cast(field.dataType)
        if field.name in have:
            return typed(F.col(field.name), have[field.name], field.dataType)
        return F.lit(defaults.get(field.name)).cast(field.dataType)

    return df.select(*(column(field).alias(field.name) for field in schema))


def lineage(batch_id: str, as_of: Column | None = None) -> dict[str, Column]:
    return {
        "batch_id": F.lit(batch_id),
        "load_timestamp": F.current_timestamp() if as_of is None else as_of,
    }


def stage_financials(df: DataFrame, batch_id: str, as_of: Column | None = None) -> DataFrame:
    return conform(
        df, STAGED_FINANCIALS, defaults={"source_file": "unknown"}, constants=lineage(batch_id, as_of)
    )


def add_lineage(df: DataFrame, batch_id: str, as_of: Column | None = None) -> DataFrame:
    """RAW lineage: batch id, load time and, if absent, the source file ``unknown``."""
    columns = lineage(batch_id, as_of)
    if "source_file" not in df.columns:
        columns["source_file"] = F.lit("unknown")
    return df.withColumns(columns)


def stage_companies(
    df: DataFrame, batch_id: str, as_of: Column | None = None
) -> DataFrame | None:
    """One row per company id; None when the frame holds no company column at all."""
    from ledgerloom.operators.quality import keep_identified, remove_duplicates

    kept = [name for name in ("company_id", "company_name") if name in df.columns]
    if not kept:
        return None
    extra = [name for name in ("source_file",) if name in df.columns]
    companies = remove_duplicates(keep_identified(df.select(*kept, *extra)), ["company_id"])
    return conform(
        companies, STAGED_COMPANIES,
        defaults={"source_file": "unknown"}, constants=lineage(batch_id, as_of),
    )


def rename(df: DataFrame, have: str, want: str) -> DataFrame:
    return df.withColumnRenamed(have, want) if have in df.columns else df


def required(df: DataFrame, *columns: str) -> DataFrame:
    """A NULL in one of the columns is an error, as in a table that declares them NOT NULL."""
    def checked(name: str) -> Column:
        missing = F.raise_error(F.lit(f"{name} is NULL")).cast(df.schema[name].dataType)
        return F.when(F.col(name).isNull(), missing).otherwise(F.col(name)).alias(name)

    return df.select(*(checked(c) if c in columns else F.col(c) for c in df.columns))


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name, missing columns filled with NULL.

    Conform first where types differ: a string/int union would cast and throw.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
