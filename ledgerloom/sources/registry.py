"""Which reader serves which source, and where its RAW rows go."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerloom import schemas
from ledgerloom.config import Source
from ledgerloom.sources import json, sectioned_csv, xml

KINDS = ("xml", "json", "csv")

Read = Callable[[SparkSession, Source], DataFrame]


@dataclass(frozen=True)
class Reader:
    """``name`` None serves every source of its kind. ``dedup_keys`` make its rows unique.

    ``read_outcomes`` reads a source whose elements may give no row: one pass over it gives the rows of
    ``read``, with NULL in record_data and rejection_reason, and what no row can be made of. With ``check``
    these other records tell of whole documents: it gives the ``problem`` of each that is broken.
    """

    kind: str
    name: str | None
    raw_table: str
    raw_schema: T.StructType
    read: Read
    read_metadata: Read | None = None
    read_outcomes: Read | None = None
    check: Callable[[Source, DataFrame, DataFrame], DataFrame] | None = None
    dedup_keys: tuple[str, ...] = ()


@dataclass(frozen=True)
class Extract:
    data: DataFrame
    metadata: DataFrame | None = None


METADATA_TABLE = "raw/csv_metadata"

READERS: tuple[Reader, ...] = (
    Reader("xml", "xbrl_xml", "raw/xml_xbrl_data", schemas.RAW_PERIOD_XML, xml.read_periods,
           read_outcomes=xml.read_period_outcomes, check=xml.check(xml.PERIOD_TAG)),
    Reader("xml", "hierarchical_xml", "raw/xml_hierarchical_data", schemas.RAW_HIERARCHICAL_XML,
           xml.read_companies, read_outcomes=xml.read_company_outcomes, check=xml.check(xml.COMPANY_TAG)),
    Reader("json", "financials_json", "raw/json_financials_data", schemas.RAW_NESTED_JSON,
           json.read_nested, read_outcomes=json.read_nested_outcomes),
    Reader("json", "period_json", "raw/json_period_data", schemas.RAW_PERIOD_JSON,
           json.read_periods, read_outcomes=json.read_period_outcomes),
    Reader("csv", None, "raw/csv_data", schemas.RAW_CSV, sectioned_csv.read_tables,
           sectioned_csv.read_metadata, dedup_keys=("company_id", "year")),
)


def reader_for(source: Source) -> Reader | None:
    """None for an unknown kind, which a run skips; an unknown name of a known kind is an error."""
    if source.kind not in KINDS:
        return None
    for reader in READERS:
        if reader.kind == source.kind and reader.name in (None, source.name):
            return reader
    raise ValueError(f"unknown {source.kind} source: {source.name}")


def extract(spark: SparkSession, source: Source) -> Extract | None:
    reader = reader_for(source)
    if reader is None:
        return None
    metadata = reader.read_metadata(spark, source) if reader.read_metadata else None
    return Extract(reader.read(spark, source), metadata)
