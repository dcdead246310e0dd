"""Declared schemas of every table. Nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


STRING, INT, LONG = T.StringType(), T.IntegerType(), T.LongType()
TIMESTAMP, BOOLEAN = T.TimestampType(), T.BooleanType()

LINEAGE = [("source_file", STRING), ("batch_id", STRING), ("load_timestamp", TIMESTAMP)]

RAW_PERIOD_XML = _schema(
    ("company_id", STRING), ("period", STRING), ("revenue", STRING), ("profit", STRING), *LINEAGE
)
RAW_HIERARCHICAL_XML = _schema(
    ("company_id", STRING), ("company_name", STRING), ("revenue", STRING), ("year", STRING), *LINEAGE
)
RAW_NESTED_JSON = _schema(
    ("company_id", STRING), ("year", STRING), ("revenue", STRING), ("currency", STRING), *LINEAGE
)
RAW_PERIOD_JSON = _schema(
    ("company_id", STRING), ("period", STRING), ("revenue", STRING), *LINEAGE
)
RAW_CSV = _schema(
    ("company_id", STRING), ("profit", STRING), ("year", STRING), ("remarks", STRING),
    ("table_index", INT), *LINEAGE,
)
RAW_CSV_METADATA = _schema(("field_name", STRING), ("field_value", STRING), *LINEAGE)

# What stands beside RAW rows in a folder of its own: records that no row can be made of.
UNUSABLE_RECORDS = _schema(("record_data", STRING), ("rejection_reason", STRING), ("usable", BOOLEAN), ("source_file", STRING))

STAGED_FINANCIALS = _schema(
    ("company_id", STRING), ("company_name", STRING), ("period_type", STRING), ("year", INT),
    ("revenue", MONEY), ("revenue_usd", MONEY), ("profit", MONEY), ("currency", STRING), *LINEAGE,
)
STAGED_COMPANIES = _schema(("company_id", STRING), ("company_name", STRING), *LINEAGE)
REJECT_LOG = _schema(
    ("source_file", STRING), ("record_data", STRING), ("rejection_reason", STRING),
    ("severity", STRING), ("batch_id", STRING), ("rejected_at", TIMESTAMP),
)

# Surrogate keys are 64-bit: a 32-bit sequence runs out at warehouse scale.
COMPANY_DIMENSION = _schema(
    ("dim_company_sk", LONG), ("company_id", STRING), ("company_name", STRING),
    ("valid_from", TIMESTAMP), ("valid_to", TIMESTAMP), ("is_current", BOOLEAN),
    ("created_at", TIMESTAMP), ("updated_at", TIMESTAMP),
)
FINANCIAL_FACT = _schema(
    ("dim_company_sk", LONG), ("company_id", STRING), ("period_type", STRING), ("year", INT),
    ("revenue", MONEY), ("revenue_usd", MONEY), ("profit", MONEY), ("currency", STRING), *LINEAGE,
)
# Which keys the facts of a batch and source may hold: bitmaps of hashed keys per source file.
FACT_KEY_SUMMARY = _schema(("batch_id", STRING), ("source", STRING), ("source_file", STRING), ("bucket", LONG), ("bits", T.BinaryType()))
RUN_LOG = _schema(
    ("run_id", STRING), ("start_time", TIMESTAMP), ("end_time", TIMESTAMP), ("status", STRING),
    ("records_processed", LONG), ("records_rejected", LONG), ("source_files", STRING),
    ("failed_sources", STRING), ("error_message", STRING), ("created_at", TIMESTAMP),
)
