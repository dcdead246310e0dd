"""One batch: extract, keep RAW, validate, stage, load the dimension, then the facts."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import schemas
from ledgerloom.config import RunConfig, Source
from ledgerloom.operators import facts, quality, scd2
from ledgerloom.operators.conform import add_lineage, conform, required, stack, stage_companies, stage_financials
from ledgerloom.plans.shapes import shape
from ledgerloom.plans.views import register_views
from ledgerloom.sinks import DimensionStore, Warehouse
from ledgerloom.sources import reader_for
from ledgerloom.sources.registry import METADATA_TABLE

log = logging.getLogger(__name__)

REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"
FINANCIALS, COMPANIES = "staging/stg_financials", "staging/stg_companies"
REJECTS, FACTS = "staging/stg_reject_log", "dwh/fact_financials"
FACT_KEYS = "dwh/fact_keys"


@dataclass
class SourceResult:
    staged: int
    has_companies: bool
    report: dict[str, int]
    duplicates: int = 0
    unusable: int = 0


@dataclass
class RunResult:
    batch_id: str
    status: str = "RUNNING"
    staged: int = 0
    rejected: int = 0
    facts: int = 0
    unresolved: int = 0
    dimension: dict[str, int] = field(default_factory=dict)
    quality: dict[str, int] = field(default_factory=dict)
    duplicates: dict[str, int] = field(default_factory=dict)
    unusable: dict[str, int] = field(default_factory=dict)
    failed: dict[str, str] = field(default_factory=dict)
    seconds: float = 0.0


def new_batch_id(prefix: str, at: datetime) -> str:
    return f"{prefix}_{at:%Y%m%d_%H%M%S}_{uuid.uuid4().hex[:8]}"


def moment(at: datetime) -> Column:
    """The load time, to the second, as a timestamp of the session's time zone."""
    return F.lit(f"{at:%Y-%m-%d %H:%M:%S}").cast("timestamp")


def run(
    spark: SparkSession,
    config: RunConfig,
    warehouse: Warehouse,
    batch_id: str | None = None,
    at: datetime | None = None,
    null_safe: bool = False,
    all_reasons: bool = False,
) -> RunResult:
    """Run one batch and record it.

    A failing source is recorded and skipped, its RAW rows stay; a failing warehouse
    load fails the run. ``null_safe`` lets facts without a period count as known on
    a rerun; ``all_reasons`` names every failing rule of a rejected row, also a rule
    that no otherwise valid row fails.
    """
    at = (at or datetime.now()).replace(microsecond=0)
    result = RunResult(batch_id or new_batch_id(config.batch_prefix, at))
    started = datetime.now()
    record = {
        "run_id": result.batch_id, "start_time": at, "status": "RUNNING",
        "source_files": str([s.name for s in config.sources]), "created_at": started,
    }
    _log_run(warehouse, record)
    repeated_keys = spark.conf.get(REPEATED_KEYS, None)
    spark.conf.set(REPEATED_KEYS, "true")  # of a JSON key that occurs twice the last value counts
    try:
        loaded: dict[str, SourceResult] = {}
        for source in config.sources:
            try:
                done = load_source(
                    spark, source, config, warehouse, result.batch_id, at, all_reasons
                )
            except Exception as error:  # one bad source must not stop the others
                log.error("source %s failed: %s", source.name, error)
                result.failed[source.name] = error_text(error)
                continue
            if done is not None:
                loaded[source.name] = done
        _summarise(result, loaded)
        load_dimension(warehouse, loaded, result, at)
        load_facts(warehouse, loaded, result, at, null_safe)
        result.status = "SUCCESS"
    except Exception as error:
        result.status = "FAILED"
        record["error_message"] = error_text(error)
        raise
    finally:
        spark.conf.unset(REPEATED_KEYS) if repeated_keys is None else spark.conf.set(REPEATED_KEYS, repeated_keys)
        ended = datetime.now()
        result.seconds = (ended - started).total_seconds()
        _log_run(warehouse, {
            **record, "status": result.status, "end_time": ended, "created_at": ended,
            "records_processed": result.staged, "records_rejected": result.rejected,
            "failed_sources": str(sorted(result.failed)) if result.failed else None,
        })
        log.info("batch %s: %s", result.batch_id, result)
    return result


def _log_run(warehouse: Warehouse, record: dict[str, object]) -> None:
    """A run log that can't be written is an error of its own; the run goes on, and its error is not hidden."""
    try:
        warehouse.log_run(record)
    except Exception as error:
        log.error("run record %s not written: %s", record["run_id"], error)


def load_source(
    spark: SparkSession, source: Source, config: RunConfig, warehouse: Warehouse,
    batch_id: str, at: datetime, all_reasons: bool = False,
) -> SourceResult | None:
    """Files to RAW, then RAW to staging. Files are parsed once; all later steps read RAW.

    Records that give no row are written in the same pass, beside RAW in a folder of their own.
    """
    reader = reader_for(source)
    if reader is None:
        log.error("unknown source kind %s of %s: skipped", source.kind, source.name)
        return None
    now = moment(at)

    def save(df: DataFrame, table: str) -> int:
        return warehouse.write(df, table, batch_id, source.name)

    # What the rules say of the rows is counted while RAW is written.
    if reader.read_outcomes is None:
        raw = conform(add_lineage(reader.read(spark, source), batch_id, now), reader.raw_schema)
        report = warehouse.write_counted(raw, reader.raw_table, batch_id, source.name, quality.report_counts(raw))
    else:
        raw = add_lineage(reader.read_outcomes(spark, source), batch_id, now).withColumn("usable", F.col("rejection_reason").isNull())
        whole = T.StructType([*reader.raw_schema, *(f for f in schemas.UNUSABLE_RECORDS if f.name not in reader.raw_schema.names)])
        raw = conform(raw, whole)
        counts = quality.report_counts(raw, only=F.col("usable"))
        report = warehouse.write_counted(raw, reader.raw_table, batch_id, source.name, counts, ["usable"])
    rows = report.pop("rows")
    log.info("source %s: %d records, columns %s", source.name, rows, raw.columns)
    if reader.read_metadata is not None:
        metadata = add_lineage(reader.read_metadata(spark, source), batch_id, now)
        save(conform(metadata, schemas.RAW_CSV_METADATA), METADATA_TABLE)

    body = warehouse.read(reader.raw_table, reader.raw_schema, batch_id, source.name).drop(
        "batch_id", "load_timestamp"
    )
    others = None
    if reader.read_outcomes is not None:
        others = warehouse.read(reader.raw_table, schemas.UNUSABLE_RECORDS, batch_id, source.name).where("NOT usable")
    if reader.check is not None:
        broken = reader.check(source, others, body).first()
        if broken is not None:
            warehouse.drop(reader.raw_table, batch_id, source.name)
            raise ValueError(broken.problem)
    reported = None if all_reasons else [code for code, n in report.items() if n > 0]
    valid, rejected = quality.validate(body, reported=reported)
    # Also without rejects: a run of the same batch before may have left some.
    unusable = save_rejects(
        rejected, source, config, warehouse, batch_id, at, report["total_rejected"], others if reader.check is None else None)

    unique = quality.remove_duplicates(valid, reader.dedup_keys) if reader.dedup_keys else valid
    shaped = shape(unique, source.name, config.rules, config.rates, config.rules_everywhere)
    staged = save(required(stage_financials(shaped, batch_id, now), "company_id"), FINANCIALS)
    # Staging keeps every unique row, so what is missing was a duplicate.
    duplicates = report["total_passed"] - staged
    if duplicates:
        log.info("source %s: %d duplicates removed", source.name, duplicates)
    has_companies = "company_name" in shaped.columns
    if has_companies:
        stored = warehouse.read(FINANCIALS, schemas.STAGED_FINANCIALS, batch_id, source.name)
        save(required(stage_companies(stored, batch_id, now), "company_id"), COMPANIES)
    return SourceResult(staged, has_companies, report, duplicates, unusable)


def save_rejects(
    rejected: DataFrame, source: Source, config: RunConfig, warehouse: Warehouse,
    batch_id: str, at: datetime, known: int, unreadable: DataFrame | None = None,
) -> int:
    """Reject log and, if configured, a CSV folder of the ``known`` rejected rows.

    Elements that gave no row (``unreadable``) join the log; returns their number. An error
    here is logged, not raised.
    """
    unusable = 0
    try:
        entries = quality.reject_log(rejected, source.name, batch_id, moment(at))
        if unreadable is not None:
            entries = stack([entries, quality.unusable_log(unreadable, source.name, batch_id, moment(at))])
        unusable = warehouse.write(entries, REJECTS, batch_id, source.name) - known
        if unusable:
            log.warning("source %s: %d records without a usable row", source.name, unusable)
        if config.reject_path and known:
            target = f"{config.reject_path.rstrip('/')}/reject_{source.name}_{at:%Y%m%d_%H%M%S}.csv"
            rejected.write.option("header", True).mode("overwrite").csv(target)
    except Exception as error:  # rejects are a report, the valid rows go on
        log.error("rejects of %s not written: %s", source.name, error)
    return unusable


def load_dimension(
    warehouse: Warehouse, loaded: dict[str, SourceResult], result: RunResult, at: datetime
) -> None:
    named = [name for name, done in loaded.items() if done.has_companies]
    if not named:
        log.warning("no company data to load")
        return
    frames = [
        warehouse.read(COMPANIES, schemas.STAGED_COMPANIES, result.batch_id, name) for name in named
    ]
    result.dimension = DimensionStore(warehouse).apply(
        scd2.company_input(frames), result.batch_id, moment(at), at
    )


def load_facts(
    warehouse: Warehouse, loaded: dict[str, SourceResult], result: RunResult, at: datetime,
    null_safe: bool,
) -> None:
    """Append new facts; the dimension is already stored, so they meet its new keys.

    Facts lie under batch and source. With the facts of a batch a summary of their keys is kept; known keys
    are looked for only in folders whose summary has something in common with the new rows', not in
    the whole history.
    """
    if not loaded:
        log.warning("no financial data to load")
        return
    staged = stack([
        warehouse.read(FINANCIALS, schemas.STAGED_FINANCIALS, result.batch_id, name)
        .withColumn("source", F.lit(name))
        for name in loaded
    ])
    # This batch's own facts are about to be replaced, so they do not count as known.
    folders = known_folders(warehouse, staged, list(loaded), result.batch_id, null_safe)
    existing = warehouse.read(FACTS, schemas.FINANCIAL_FACT, folders=folders)
    fresh = facts.new_facts(
        staged, DimensionStore(warehouse).current(), existing, result.batch_id, moment(at),
        null_safe, scope="source_file", kept=["source"],
    )
    # A summary never tells of less than its facts: it goes before they are replaced and comes after they are written.
    warehouse.drop(FACT_KEYS, result.batch_id)
    result.facts = warehouse.write(
        fresh, FACTS, result.batch_id, skip_empty=True, partition_by=["source"])
    if not result.facts:
        log.info("no new facts")
        return
    stored = warehouse.read(FACTS, T.StructType([*schemas.FINANCIAL_FACT, T.StructField("source", T.StringType())]), result.batch_id)
    warehouse.write(facts.key_summary(stored, ["source"]), FACT_KEYS, result.batch_id)
    result.unresolved = int(facts.resolution_counts(stored).first()["unresolved"])
    if result.unresolved:
        log.warning("%d facts have no company in the dimension", result.unresolved)


def known_folders(
    warehouse: Warehouse, staged: DataFrame, sources: Sequence[str], batch_id: str, null_safe: bool = False
) -> list[tuple[str, str]]:
    """Batches and sources whose facts may hold a key of the staged rows, but for this batch's own, which are to be replaced.

    A batch without a summary (its load died before it, or is older than summaries) may hold any.
    """
    def batches(table: str) -> set[str]:
        names = warehouse.folders(warehouse.path(table))
        return {n.removeprefix("batch_id=") for n in names if n.startswith("batch_id=")} - {batch_id}

    summed = batches(FACT_KEYS)
    # Of every batch and source at most one entry.
    folders = [(batch, source) for batch in batches(FACTS) - summed for source in sources]
    if summed:
        stored = warehouse.read(FACT_KEYS, schemas.FACT_KEY_SUMMARY).where(F.col("batch_id") != batch_id)
        found = facts.folders_with_keys(staged, stored, ["batch_id", "source"], ["source"], null_safe)
        folders += [(r.batch_id, r.source) for r in found.collect()]
    return sorted(folders)


def views(warehouse: Warehouse) -> None:
    """Register the reporting views over the stored tables."""
    register_views(
        warehouse.read(FACTS, schemas.FINANCIAL_FACT), DimensionStore(warehouse).read()
    )


def _summarise(result: RunResult, loaded: dict[str, SourceResult]) -> None:
    for name, done in loaded.items():
        result.duplicates[name] = done.duplicates
        if done.unusable:
            result.unusable[name] = done.unusable
        result.staged += done.staged
        result.rejected += done.report["total_rejected"] + done.unusable
        for name, count in done.report.items():
            result.quality[name] = result.quality.get(name, 0) + count


def error_text(error: Exception) -> str:
    """The whole text of an error, and that of its innermost Java cause where it says more."""
    text = str(error) or type(error).__name__
    java = getattr(error, "java_exception", None)
    if java is not None:
        while java.getCause() is not None:
            java = java.getCause()
        cause = java.getMessage() or java.toString()
        if cause not in text:
            text = f"{cause}\n{text}"
    return text
