"""Sources, rates and mapping rules of a run."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# US-dollar rate of each currency code.
DEFAULT_RATES: dict[str, float] = {"USD": 1.0, "EUR": 1.08, "INR": 0.012}

@dataclass(frozen=True)
class Source:
    """One input: registry name, kind (``xml``, ``json``, ``csv``), path and reader options."""

    name: str
    kind: str
    path: str
    options: Mapping[str, str] = field(default_factory=dict)

    def flag(self, option: str, default: bool) -> bool:
        return str(self.options.get(option, default)).lower() == "true"


@dataclass(frozen=True)
class MappingRule:
    source_field: str
    target_column: str
    transformation: str
    datatype: str


# The seed rows of the mapping table.
DEFAULT_RULES: tuple[MappingRule, ...] = (
    MappingRule("ID", "company_id", "direct", "varchar"),
    MappingRule("Name", "company_name", "upper", "varchar"),
    MappingRule("Revenue", "revenue", "currency_convert", "numeric"),
    MappingRule("Profit", "profit", "split_comma", "numeric"),
    MappingRule("Year", "year", "direct", "int"),
    MappingRule("Currency", "currency", "direct", "varchar"),
    MappingRule("Period", "period_type", "map_cy_py", "varchar"),
)


@dataclass(frozen=True)
class RunConfig:
    sources: tuple[Source, ...]
    rates: Mapping[str, float] = field(default_factory=lambda: dict(DEFAULT_RATES))
    rules: tuple[MappingRule, ...] = DEFAULT_RULES
    reject_path: str | None = None
    rules_everywhere: bool = False
    batch_prefix: str = "ETL"


def load_config(path: str, rules: Iterable[MappingRule] = DEFAULT_RULES) -> RunConfig:
    """Read sources, rates and paths from a JSON file. Logins are never kept in it."""
    with open(path, encoding="utf-8") as handle:
        raw = json.load(handle)
    sources = tuple(
        Source(item["name"], item["type"], item["path"], item.get("options", {}))
        for item in raw["sources"]
    )
    settings = raw.get("pipeline", {})
    return RunConfig(
        sources=sources,
        rates={code: float(rate) for code, rate in raw["currency_rates"].items()},
        rules=tuple(rules),
        reject_path=settings.get("reject_path"),
        rules_everywhere=bool(settings.get("rules_everywhere", False)),
        batch_prefix=settings.get("batch_id_prefix", "ETL"),
    )


def read_rules(spark: SparkSession, location: str, format: str = "csv", **options: str) -> DataFrame:
    """Mapping table as a DataFrame: a CSV file with header, a catalog table, or any format."""
    columns = ("source_field", "target_column", "transformation", "datatype")
    if format == "table":
        return spark.read.table(location).select(*columns)
    reader = spark.read.format(format).options(**options)
    if format == "csv":
        reader = reader.option("header", True).schema(", ".join(f"{c} string" for c in columns))
    if format == "jdbc":
        return reader.option("dbtable", location).load().select(*columns)
    return reader.load(location).select(*columns)


def collect_rules(table: DataFrame) -> tuple[MappingRule, ...]:
    """Rules in table order. Each shapes the query plan, so the driver needs them all, however many."""
    return tuple(MappingRule(*row) for row in table.toLocalIterator())


def rules_by_field(rules: Iterable[MappingRule]) -> dict[str, MappingRule]:
    """One rule per source field, in first-seen order; the last rule of a field counts."""
    return {rule.source_field: rule for rule in rules}
