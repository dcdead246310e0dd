"""Column transformations driven by a rule table."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import MappingRule, rules_by_field
from ledgerloom.functions import leading_number, to_double, to_int

log = logging.getLogger(__name__)

Transformation = Callable[[DataFrame, str, MappingRule, Mapping[str, float]], Column]

# Spellings of the two reporting periods.
CURRENT_YEAR = ("CY", "CURRENT YEAR", "CURRENT")
PREVIOUS_YEAR = ("PY", "PREVIOUS YEAR", "PREVIOUS")


def direct(df: DataFrame, source: str, rule: MappingRule, rates: Mapping[str, float]) -> Column:
    if rule.datatype == "int":
        return to_int(F.col(source), df.schema[source].dataType)
    if rule.datatype == "numeric":
        return to_double(F.col(source))
    return F.col(source)


def upper(df: DataFrame, source: str, rule: MappingRule, rates: Mapping[str, float]) -> Column:
    return F.upper(source)


def usd_rate(currency: Column, rates: Mapping[str, float]) -> Column:
    """Rate of a currency code in any letter case; 1.0 when unknown or NULL."""
    if not rates:
        return F.lit(1.0)
    pairs = [F.lit(part) for code, rate in rates.items() for part in (code, float(rate))]
    return F.coalesce(F.create_map(*pairs)[F.upper(currency)], F.lit(1.0))


def currency_convert(
    df: DataFrame, source: str, rule: MappingRule, rates: Mapping[str, float]
) -> Column:
    """Amount in US dollars, two decimals; without a currency column an unrounded copy."""
    amount = to_double(F.col(source))
    if "currency" not in df.columns:
        return amount
    return F.round(amount * usd_rate(F.col("currency"), rates), 2)


def split_comma(df: DataFrame, source: str, rule: MappingRule, rates: Mapping[str, float]) -> Column:
    return leading_number(F.col(source).cast("string"))


def map_cy_py(df: DataFrame, source: str, rule: MappingRule, rates: Mapping[str, float]) -> Column:
    period = F.upper(source)
    return (
        F.when(period.isin(*CURRENT_YEAR), "CY")
        .when(period.isin(*PREVIOUS_YEAR), "PY")
        .otherwise(period)
    )


TRANSFORMATIONS: dict[str, Transformation] = {
    "direct": direct,
    "upper": upper,
    "currency_convert": currency_convert,
    "split_comma": split_comma,
    "map_cy_py": map_cy_py,
}


# Columns that a transformation reads besides its source; one not listed may read any.
READS: dict[Transformation, tuple[str, ...]] = {
    direct: (), upper: (), currency_convert: ("currency",), split_comma: (), map_cy_py: (),
}


def apply_rule(
    df: DataFrame, source: str, rule: MappingRule, rates: Mapping[str, float],
    transformations: Mapping[str, Transformation] = TRANSFORMATIONS,
) -> DataFrame:
    """Add or replace the rule's target column; an unknown transformation copies directly."""
    return df.withColumn(rule.target_column, _converted(df, source, rule, rates, transformations))


def _converted(
    df: DataFrame, source: str, rule: MappingRule, rates: Mapping[str, float],
    transformations: Mapping[str, Transformation],
) -> Column:
    transform = transformations.get(rule.transformation)
    if transform is None:
        log.warning("unknown transformation %s: copying directly", rule.transformation)
        transform = direct
    return transform(df, source, rule, rates)


def apply_rules(
    df: DataFrame,
    rules: Iterable[MappingRule],
    rates: Mapping[str, float],
    aliases: Mapping[str, str] | None = None,
    targets: Mapping[str, str] | None = None,
    transformations: Mapping[str, Transformation] = TRANSFORMATIONS,
) -> DataFrame:
    """Apply every rule whose source column exists, in rule order; sources are kept.

    ``aliases`` names the column that stands for a source field; ``targets``
    redirects a rule to another column. A later rule sees what an earlier one wrote.

    Rules that don't read what another of them writes form a layer, which is one
    projection; a rule that reads an earlier target opens the next. So planning takes
    time by the number of layers, not of rules.
    """
    aliases, targets = aliases or {}, targets or {}
    known, layer = set(df.columns), {}
    for source_field, rule in rules_by_field(rules).items():
        source = aliases.get(source_field, source_field)
        if source not in known:
            continue
        target = targets.get(source_field, rule.target_column)
        others = READS.get(transformations.get(rule.transformation, direct))
        if layer and (others is None or not layer.keys().isdisjoint({source, *others})):
            df, layer = df.withColumns(layer), {}
        redirected = MappingRule(source_field, target, rule.transformation, rule.datatype)
        layer[target] = _converted(df, source, redirected, rates, transformations)
        known.add(target)
    return df.withColumns(layer) if layer else df


def convert_with_rate_table(
    df: DataFrame, rates: DataFrame, source: str = "revenue", target: str = "revenue_usd"
) -> DataFrame:
    """Currency conversion against a ``(currency, rate)`` table, one row per code.

    A left join without a hint: Spark broadcasts the table when its size allows and
    shuffles otherwise. Result equals :func:`currency_convert` with the same rates.
    """
    table = rates.select(F.col("currency").alias("_code"), F.col("rate").cast("double").alias("_rate"))
    joined = df.join(table, F.upper(F.col("currency")) == F.col("_code"), "left")
    amount = to_double(F.col(source)) * F.coalesce("_rate", F.lit(1.0))
    return joined.withColumn(target, F.round(amount, 2)).drop("_code", "_rate")
