"""The three reporting views, as DataFrames and as temporary views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.conform import stack
from ledgerloom.operators.scd2 import current


def company_summary(facts: DataFrame, dimension: DataFrame, by: str = "surrogate_key") -> DataFrame:
    """Facts with the name of their company, current versions only.

    By surrogate key a fact loaded before a name change drops out, since its
    version is closed; ``by="business_key"`` shows it under the current name.
    """
    names = current(dimension)
    if by == "surrogate_key":
        names = names.select("dim_company_sk", "company_id", "company_name")
        joined = facts.drop("company_id").join(names, "dim_company_sk")
    elif by == "business_key":
        joined = facts.join(names.select("company_id", "company_name"), "company_id")
    else:
        raise ValueError(f"by must be surrogate_key or business_key, not {by!r}")
    return joined.select(
        "company_id", "company_name", "period_type", "year", "revenue", "revenue_usd",
        "profit", "currency", "source_file", "load_timestamp",
    )


def revenue_comparison(facts: DataFrame, dimension: DataFrame, grain: str = "fact") -> DataFrame:
    """Current against previous year per company and source file, with growth in percent.

    Every current company appears, also without a current-year fact. By ``grain="fact"``
    every current-year fact meets every previous-year fact of its company and file, so a
    company with many of both gives their product; by ``grain="company_file"`` revenues are
    summed per company and file first (the year shown is the latest), which keeps one row
    for each and lets one shuffle of partial sums do.

    By fact it is written as three disjoint parts joined by inner and anti joins instead of
    two outer joins: an outer join cannot split a hot key on its optional side, an inner
    join can split either, so a company holding much of the fact table does not end in one
    task.
    """
    if grain == "company_file":
        return _summed_comparison(facts, dimension)
    if grain != "fact":
        raise ValueError(f"grain must be fact or company_file, not {grain!r}")
    companies = current(dimension).select("dim_company_sk", "company_id", "company_name")
    facts = facts.where(F.col("dim_company_sk").isNotNull())
    this_year = facts.where("period_type = 'CY'").select(
        "dim_company_sk", "source_file", F.col("revenue_usd").alias("cy_revenue_usd"),
        F.col("year").alias("cy_year"),
    )
    last_year = facts.where("period_type = 'PY'").select(
        "dim_company_sk", "source_file", F.col("revenue_usd").alias("py_revenue_usd")
    )
    grain = ["dim_company_sk", "source_file"]
    paired = this_year.join(last_year, grain)
    unpaired = this_year.join(last_year.select(*grain).distinct(), grain, "left_anti")
    with_current = companies.join(stack([paired, unpaired]), "dim_company_sk")
    without = companies.join(
        this_year.select("dim_company_sk").distinct(), "dim_company_sk", "left_anti"
    )
    return _with_growth(stack([with_current, without]))


def _with_growth(compared: DataFrame) -> DataFrame:
    cy, py = F.col("cy_revenue_usd").cast("double"), F.col("py_revenue_usd").cast("double")
    growth = F.when(py > 0, F.round((cy - py) / py * 100, 2))
    return compared.select(
        "company_id", "company_name", "cy_revenue_usd", "py_revenue_usd",
        growth.alias("revenue_growth_pct"), "cy_year",
    )


def _summed_comparison(facts: DataFrame, dimension: DataFrame) -> DataFrame:
    """One read of the facts: both years are summed side by side, in tasks first."""
    def total(period: str, column: str) -> Column:
        return F.sum(F.when(F.col("period_type") == period, F.col(column)))

    sums = (
        facts.where("dim_company_sk IS NOT NULL AND period_type IN ('CY', 'PY')")
        .groupBy("dim_company_sk", "source_file").agg(
            total("CY", "revenue_usd").alias("cy_revenue_usd"),
            total("PY", "revenue_usd").alias("py_revenue_usd"),
            F.max(F.when(F.col("period_type") == "CY", F.col("year"))).alias("cy_year"),
            F.count_if(F.col("period_type") == "CY").alias("_rows"),
        ).where("_rows > 0")
    )
    companies = current(dimension).select("dim_company_sk", "company_id", "company_name")
    # Sums and companies hold few rows per key: an outer join has no hot side here.
    return _with_growth(companies.join(sums, "dim_company_sk", "left"))


def company_history(dimension: DataFrame) -> DataFrame:
    return dimension.select(
        "dim_company_sk", "company_id", "company_name", "valid_from", "valid_to", "is_current",
        F.when(F.col("is_current"), "Active").otherwise("Historical").alias("record_status"),
        "updated_at",
    ).orderBy("company_id", "valid_from")


def register_views(facts: DataFrame, dimension: DataFrame) -> None:
    """Make the views available to ``spark.sql``."""
    company_summary(facts, dimension).createOrReplaceTempView("v_company_financials_summary")
    revenue_comparison(facts, dimension).createOrReplaceTempView("v_revenue_comparison")
    company_history(dimension).createOrReplaceTempView("v_company_history")
