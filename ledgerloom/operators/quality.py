"""One-pass validation, reject records, quality counts and duplicate removal."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATUS, REASON = "_dq_status", "_dq_reason"


@dataclass(frozen=True)
class Rule:
    """A row check on one column. Severity ``reject`` removes the row, ``warn`` only counts it."""

    code: str
    column: str
    fails: Callable[[Column], Column]
    shows_value: bool = False
    severity: str = "reject"

    def failure(self) -> Column:
        return self.fails(F.col(self.column))

    def text(self) -> Column:
        if not self.shows_value:
            return F.lit(f"{self.code}; ")
        return F.concat(F.lit(f"{self.code}("), F.col(self.column).cast("string"), F.lit("); "))


def _blank(value: Column) -> Column:
    return F.trim(value) == ""


def _filled(value: Column) -> Column:
    return value.isNotNull() & ~_blank(value)


MISSING_COMPANY_ID = Rule("MISSING_COMPANY_ID", "company_id", lambda c: c.isNull() | _blank(c))
INVALID_YEAR = Rule(
    "INVALID_YEAR", "year", lambda c: _filled(c) & ~c.rlike(r"^\d{4}$"), shows_value=True
)
PROFIT_FORMAT = Rule(
    "INVALID_PROFIT", "profit", lambda c: _filled(c) & ~c.rlike(r"^\d"), severity="warn"
)
RULES: tuple[Rule, ...] = (MISSING_COMPANY_ID, INVALID_YEAR, PROFIT_FORMAT)


def applicable(df: DataFrame, rules: Sequence[Rule], severity: str) -> list[Rule]:
    present = set(df.columns)
    return [r for r in rules if r.severity == severity and r.column in present]


def _never() -> Column:
    return F.lit(False)


def _any_failure(rules: Sequence[Rule]) -> Column:
    failed = _never()
    for rule in rules:
        failed = failed | F.coalesce(rule.failure(), F.lit(False))
    return failed


def reason_text(rules: Sequence[Rule]) -> Column:
    """``CODE; `` of every failing rule, in rule order; empty for a valid row."""
    return F.concat(F.lit(""), *(F.when(r.failure(), r.text()).otherwise("") for r in rules))


def validate(
    df: DataFrame, rules: Sequence[Rule] = RULES, reported: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Split into valid rows and rejected rows with status and reason columns.

    ``reported`` limits which codes the reason text mentions, never which rows are
    rejected. A batch that lists only codes some otherwise valid row fails passes
    them here; by default every failing rule is named.
    """
    checks = applicable(df, rules, "reject")
    failed = _any_failure(checks)
    named = [r for r in checks if reported is None or r.code in reported]
    rejected = df.where(failed).withColumns(
        {STATUS: F.lit("REJECTED"), REASON: reason_text(named)}
    )
    return df.where(~failed), rejected


def report_counts(df: DataFrame, rules: Sequence[Rule] = RULES, only: Column | None = None) -> list[Column]:
    """The counts of ``quality_report`` as aggregates, e.g. to be observed while ``df`` is written.

    ``only``: rows that it is not true of count nowhere.
    """
    checks, warnings = applicable(df, rules, "reject"), applicable(df, rules, "warn")
    failed = _any_failure(checks)
    counted = F.lit(True) if only is None else only
    counts = [
        F.count_if(counted).alias("total_input"),
        F.count_if(counted & ~failed).alias("total_passed"),
        F.count_if(counted & failed).alias("total_rejected"),
    ]
    earlier: list[Rule] = []
    for rule in checks:
        first = rule.failure() & ~_any_failure(earlier)
        counts.append(F.count_if(counted & first).alias(rule.code))
        earlier.append(rule)
    return counts + [F.count_if(counted & rule.failure() & ~failed).alias(rule.code) for rule in warnings]


def quality_report(df: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row of counts: input, passed, rejected, one column per rule code.

    A reject rule counts rows it is the *first* to fail; a warning counts its rows
    that no reject rule removed. A single aggregation with partial sums per task.
    """
    return df.agg(*report_counts(df, rules))


def reject_log(
    rejected: DataFrame, source_name: str, batch_id: str, as_of: Column | None = None
) -> DataFrame:
    """Rejected rows as JSON text; NULL fields are left out of the JSON."""
    fields = [c for c in rejected.columns if c not in (STATUS, REASON)]
    return rejected.select(
        F.lit(source_name).alias("source_file"),
        F.to_json(F.struct(*fields)).alias("record_data"),
        F.col(REASON).alias("rejection_reason"),
        F.lit("ERROR").alias("severity"),
        F.lit(batch_id).alias("batch_id"),
        (F.current_timestamp() if as_of is None else as_of).alias("rejected_at"),
    )


def unusable_log(
    found: DataFrame, source_name: str, batch_id: str, as_of: Column | None = None
) -> DataFrame:
    """Log entries of what a reader could make no row of: ``record_data, rejection_reason``."""
    return found.select(
        F.lit(source_name).alias("source_file"), "record_data", "rejection_reason",
        F.lit("ERROR").alias("severity"), F.lit(batch_id).alias("batch_id"),
        (F.current_timestamp() if as_of is None else as_of).alias("rejected_at"),
    )


def reason_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("cnt"))


def code_counts(rejects: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row: how many reject texts mention each code."""
    codes = [r.code for r in rules if r.severity == "reject"]
    return rejects.agg(
        *(F.count_if(F.col("rejection_reason").like(f"%{c}%")).alias(c.lower()) for c in codes)
    )


def remove_duplicates(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    """One row per key, NULL keys being equal; unchanged if none of the keys exists.

    The survivor is the first in ``order_by``, by default all other columns, NULLs
    last, so rows that tie are identical and the result does not depend on task order.
    Filtering on rank 1 makes Spark keep one row per key and task *before* the
    shuffle (WindowGroupLimit), so a key holding a third of the rows costs one row per task.
    """
    columns = df.columns
    present = [k for k in keys if k in columns]
    if not present:
        return df
    order = list(order_by or [c for c in columns if c not in present]) or present
    window = Window.partitionBy(*present).orderBy(*(F.col(c).asc_nulls_last() for c in order))
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def duplicate_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: input, kept and removed rows of :func:`remove_duplicates`, from one aggregation by key."""
    present = [k for k in keys if k in df.columns]
    if not present:
        return df.agg(*(F.count(F.lit(1)).alias(n) for n in ("input_rows", "kept_rows"))).withColumn(
            "removed_rows", F.lit(0).cast("bigint"))
    groups = df.groupBy(*present).agg(F.count(F.lit(1)).alias("_rows"))
    total = F.coalesce(F.sum("_rows"), F.lit(0))
    return groups.agg(
        total.alias("input_rows"), F.count(F.lit(1)).alias("kept_rows"),
        (total - F.count(F.lit(1))).alias("removed_rows"),
    )


def keep_identified(df: DataFrame) -> DataFrame:
    return df.where(F.col("company_id").isNotNull())
