"""Per-source shaping: from the columns a source has to the staged ones."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import MappingRule
from ledgerloom.functions import leading_number, to_double
from ledgerloom.operators.conform import rename
from ledgerloom.operators.mapping import apply_rules, usd_rate

log = logging.getLogger(__name__)

Rules = Sequence[MappingRule]
Rates = Mapping[str, float]
Shape = Callable[[DataFrame, Rules, Rates], DataFrame]

# The column that stands for each source field of the mapping table.
ALIASES = {
    "ID": "company_id", "Name": "company_name", "Revenue": "revenue", "Profit": "profit",
    "Year": "year", "Currency": "currency", "Period": "period",
}


def _dollars(df: DataFrame) -> DataFrame:
    """Revenue as number; without a currency it already is in US dollars."""
    amount = to_double(F.col("revenue"))
    return df.withColumns({"revenue_usd": amount, "revenue": amount})


def period_xml(df: DataFrame, rules: Rules, rates: Rates) -> DataFrame:
    renamed = rename(df, "period", "period_type")
    return _dollars(renamed).withColumn("profit", to_double(F.col("profit")))


def hierarchical_xml(df: DataFrame, rules: Rules, rates: Rates) -> DataFrame:
    aliases = {field: ALIASES[field] for field in ("Name", "Revenue", "Year", "ID")}
    mapped = apply_rules(df, rules, rates, aliases)
    if "company_name" in mapped.columns:
        mapped = mapped.withColumn("company_name", F.upper("company_name"))
    return _dollars(mapped)


def nested_json(df: DataFrame, rules: Rules, rates: Rates) -> DataFrame:
    amount = to_double(F.col("revenue"))
    converted = F.round(amount * usd_rate(F.col("currency"), rates), 2)
    return df.withColumns({"revenue_usd": converted, "revenue": amount})


def period_json(df: DataFrame, rules: Rules, rates: Rates) -> DataFrame:
    return _dollars(rename(df, "period", "period_type"))


def sectioned_csv(df: DataFrame, rules: Rules, rates: Rates) -> DataFrame:
    return df.withColumn("profit", leading_number(F.col("profit"))).drop("table_index", "remarks")


SHAPES: dict[str, Shape] = {
    "xbrl_xml": period_xml,
    "hierarchical_xml": hierarchical_xml,
    "financials_json": nested_json,
    "period_json": period_json,
    "complex_csv": sectioned_csv,
}


def by_rules(df: DataFrame, rules: Rules, rates: Rates) -> DataFrame:
    """Shape any source through the mapping table alone.

    The original revenue stays as read; the rule's converted amount goes to ``revenue_usd``.
    """
    mapped = apply_rules(df, rules, rates, ALIASES, targets={"Revenue": "revenue_usd"})
    if "revenue" in mapped.columns:
        mapped = mapped.withColumn("revenue", to_double(F.col("revenue")))
    return mapped.drop("period", "table_index", "remarks")


def shape(
    df: DataFrame, source_name: str, rules: Rules, rates: Rates, rules_everywhere: bool = False
) -> DataFrame:
    """Shape by source name; an unknown source passes through unchanged."""
    if rules_everywhere:
        return by_rules(df, rules, rates)
    chosen = SHAPES.get(source_name)
    if chosen is None:
        log.warning("no shaping for source %s", source_name)
        return df
    return chosen(df, rules, rates)
