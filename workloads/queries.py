"""One query per operator, each over whole test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.config import DEFAULT_RATES, DEFAULT_RULES, MappingRule, Source
from ledgerloom.operators import conform as conforming
from ledgerloom.operators import facts, mapping, quality, scd2
from ledgerloom.plans import dates, views
from ledgerloom.plans.shapes import shape
from ledgerloom.sources import json, sectioned_csv, xml
from ledgerloom.sources.json_split import split_elements
from workloads import inputs
from workloads.inputs import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BATCH = "batch_2"
LOAD_TIME = "2002-01-01 00:00:00"


def now() -> Column:
    return F.lit(LOAD_TIME).cast("timestamp")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def plain(df: DataFrame, *dropped: str) -> DataFrame:
    """Money as double and times as text, so that both engines show the same values."""
    def show(field: T.StructField) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        return column.alias(field.name)

    return df.select(*(show(f) for f in df.schema if f.name not in dropped))


# Sources


@query
def xml_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = inputs.period_elements(spark, sf_dir)
    return xml.period_rows(xml.parse_elements(texts, xml.PERIOD_SCHEMA))


@query
def xml_hierarchical(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = inputs.company_elements(spark, sf_dir)
    return xml.company_rows(xml.parse_elements(texts, xml.COMPANY_SCHEMA))


@query
def xml_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elements found in the text of whole documents with a default namespace."""
    elements = xml.split_elements(inputs.period_documents(spark, sf_dir), xml.PERIOD_TAG)
    return xml.period_rows(xml.parse_elements(elements, xml.PERIOD_SCHEMA))


@query
def xml_documents_prefixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents with a namespace prefix."""
    elements = xml.split_elements(inputs.period_documents(spark, sf_dir, "x"), xml.PERIOD_TAG, "x")
    return xml.period_rows(xml.parse_elements(elements, xml.PERIOD_SCHEMA))


@query
def xml_auto_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of two sources, the second with a namespace prefix that no option names; file names repeat over folders."""
    sources = (Source("xbrl_xml", "xml", f"{inputs.period_files(spark, sf_dir, prefix)}/*/*") for prefix in (None, "ns1"))
    plain, prefixed = (xml.read_periods(spark, s).drop("source_file") for s in sources)
    return plain.withColumn("prefix", F.lit("")).unionByName(prefixed.withColumn("prefix", F.lit("ns1")))


@query
def json_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json.nested_rows(inputs.nested_records(spark, sf_dir))


@query
def json_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json.period_rows(inputs.period_records(spark, sf_dir))


@query
def json_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nested records again, found in array text that is cut into blocks."""
    return json.nested_rows(json.records_of(_elements(inputs.json_pieces(spark, sf_dir)), ["company"]))


def _elements(pieces: DataFrame) -> DataFrame:
    runs = split_elements(pieces, top=0).withColumnRenamed("file", "source_file")
    return json.parse_elements(runs, inside=True)


@query
def json_mixed_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, texts, nulls and lists between the records leave the records as they are."""
    pieces = inputs.json_pieces(spark, sf_dir, inputs.OTHER_ELEMENTS)
    return json.nested_rows(json.records_of(_elements(pieces), ["company"]))


@query
def json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every element that gives no row, with the reason."""
    pieces = inputs.json_pieces(spark, sf_dir, inputs.OTHER_ELEMENTS)
    return json.rejects_of(json.nested_outcomes(_elements(pieces)))


@query
def json_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and rejects of lists, lines and single objects, the shape found file by file, in one pass."""
    runs = split_elements(inputs.json_documents(spark, sf_dir)).withColumnRenamed("file", "source_file")
    return json.nested_outcomes(json.parse_elements(runs))


@query
def json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The truthiness rule on the JSON column of ``events``: a zero counts as absent."""
    value = json.member(F.parse_json("props"), "k")
    return json.with_texts(
        table(spark, sf_dir, "events").select("event_id", value.alias("k")), ["k"]
    )


@query
def csv_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sectioned_csv.data_rows(inputs.csv_text(spark, sf_dir))


@query
def csv_multiline_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose quoted cells hold line breaks, commas and what looks like a header."""
    source = Source("complex_csv", "csv", f"{inputs.multiline_files(spark, sf_dir)}/*/*")
    return sectioned_csv.read_tables(spark, source).drop("source_file")


@query
def csv_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sectioned_csv.metadata_rows(inputs.csv_text(spark, sf_dir))


# Mapping


def _mapped(
    spark: SparkSession, sf_dir: str, rules: list[MappingRule], *shown: str
) -> DataFrame:
    read = {"line_id", *shown, *(rule.source_field for rule in rules)} & set(inputs.LEDGER)
    lines = inputs.ledger(spark, sf_dir, *sorted(read))
    return mapping.apply_rules(lines, rules, DEFAULT_RATES).select("line_id", *shown)


@query
def map_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        MappingRule("year", "year_number", "direct", "int"),
        MappingRule("profit", "profit_whole", "direct", "int"),
        MappingRule("revenue", "revenue_number", "direct", "numeric"),
        MappingRule("currency", "currency_copy", "direct", "varchar"),
        MappingRule("company_name", "name_copy", "no_such_transformation", "varchar"),
        MappingRule("no_such_column", "unused", "direct", "varchar"),
    ]
    return _mapped(
        spark, sf_dir, rules,
        "year_number", "profit_whole", "revenue_number", "currency_copy", "name_copy",
    )


@query
def map_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [MappingRule("company_name", "company_name", "upper", "varchar")]
    return _mapped(spark, sf_dir, rules, "company_name")


@query
def map_currency(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [MappingRule("revenue", "revenue_usd", "currency_convert", "numeric")]
    return _mapped(spark, sf_dir, rules, "currency", "revenue_usd")


@query
def map_currency_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same conversion against a rate table instead of configured rates."""
    rates = spark.createDataFrame(list(DEFAULT_RATES.items()), "currency string, rate double")
    lines = inputs.ledger(spark, sf_dir, "line_id", "currency", "revenue")
    converted = mapping.convert_with_rate_table(lines, rates)
    return converted.select("line_id", "currency", "revenue_usd")


@query
def map_currency_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a currency column the amount is copied and not rounded."""
    lines = inputs.ledger(spark, sf_dir, "line_id", "revenue")
    rules = [MappingRule("revenue", "revenue_usd", "currency_convert", "numeric")]
    return mapping.apply_rules(lines, rules, DEFAULT_RATES).select("line_id", "revenue_usd")


@query
def map_split_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [MappingRule("profit", "profit", "split_comma", "numeric")]
    return _mapped(spark, sf_dir, rules, "profit")


@query
def map_cy_py(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [MappingRule("period", "period_type", "map_cy_py", "varchar")]
    return _mapped(spark, sf_dir, rules, "period_type")


@query
def map_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole seed table through per-source aliases."""
    shaped = shape(
        inputs.ledger(spark, sf_dir), "ledger", DEFAULT_RULES, DEFAULT_RATES, rules_everywhere=True
    )
    return shaped.select(
        "line_id", "company_id", "company_name", "period_type", "year", "revenue",
        "revenue_usd", "profit", "currency",
    )


@query
def map_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that read what earlier rules wrote: text to number, number to dollars, and on."""
    rules = [
        MappingRule("company_name", "name", "upper", "varchar"),
        MappingRule("revenue", "amount", "split_comma", "numeric"),
        MappingRule("amount", "usd", "currency_convert", "numeric"),
        MappingRule("usd", "copy", "direct", "numeric"),
        MappingRule("period", "period", "map_cy_py", "varchar"),
        MappingRule("name", "period", "direct", "varchar"),
    ]
    lines = inputs.ledger(spark, sf_dir, "line_id", "company_name", "revenue", "period", "currency")
    mapped = mapping.apply_rules(lines, rules, DEFAULT_RATES)
    return plain(mapped.select("line_id", "name", "amount", "usd", "copy", "period"))


# Quality

CHECKED = ("line_id", "company_id", "year", "profit")


@query
def dq_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = quality.validate(inputs.ledger(spark, sf_dir, *CHECKED))
    return valid.select("line_id", "company_id", "year", "profit")


@query
def dq_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = quality.validate(inputs.ledger(spark, sf_dir, *CHECKED))
    return rejected.select(
        "line_id", F.col(quality.STATUS).alias("status"), F.col(quality.REASON).alias("reason")
    )


@query
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.quality_report(inputs.ledger(spark, sf_dir, *CHECKED))
    return report.toDF(*(name.lower() for name in report.columns))


@query
def dq_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = quality.validate(inputs.ledger(spark, sf_dir, *CHECKED))
    return valid.where(quality.PROFIT_FORMAT.failure()).select("line_id", "profit")


def _reject_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = quality.validate(inputs.ledger(spark, sf_dir))
    return quality.reject_log(rejected, "ledger", BATCH, now())


@query
def reject_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log with its JSON text read back, since engines print JSON differently."""
    def read(name: str) -> Column:
        return F.get_json_object("record_data", f"$.{name}").alias(name)

    entries = _reject_log(spark, sf_dir).select(
        read("line_id").cast("bigint").alias("line_id"), read("company_id"), read("year"),
        "source_file", "rejection_reason", "severity", "batch_id", "rejected_at",
    )
    return plain(entries)


@query
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.reason_counts(_reject_log(spark, sf_dir))


@query
def reject_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.code_counts(_reject_log(spark, sf_dir))


@query
def dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.ledger(spark, sf_dir, "line_id", "company_id", "year", "source_file")
    unique = quality.remove_duplicates(
        lines, ["company_id", "year", "no_such_column"], order_by=["source_file", "line_id"]
    )
    return unique.select("company_id", "year", "line_id", "source_file")


@query
def dedup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.ledger(spark, sf_dir, "company_id", "year")
    return quality.duplicate_counts(lines, ["company_id", "year", "no_such_column"])


# Staging


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, _ = quality.validate(inputs.ledger(spark, sf_dir))
    shaped = shape(valid, "ledger", DEFAULT_RULES, DEFAULT_RATES, rules_everywhere=True)
    return conforming.stage_financials(shaped, BATCH, now())


@query
def stage_financials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_staged(spark, sf_dir))


@query
def conform_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources with different columns, conformed and stacked."""
    valid, _ = quality.validate(inputs.ledger(spark, sf_dir))
    periods = shape(
        valid.select("company_id", "period", "revenue", "profit", "source_file"),
        "xbrl_xml", DEFAULT_RULES, DEFAULT_RATES,
    )
    years = shape(
        valid.select("company_id", "profit", "year", "source_file"),
        "complex_csv", DEFAULT_RULES, DEFAULT_RATES,
    )
    staged = [conforming.stage_financials(f, BATCH, now()) for f in (periods, years)]
    return plain(conforming.stack(staged), "load_timestamp")


@query
def union_missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("supplier"), F.col("s_name").alias("name")
    )
    return conforming.stack([customers, suppliers])


@query
def stage_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = inputs.ledger(spark, sf_dir, "company_id", "company_name", "source_file")
    companies = conforming.stage_companies(lines, BATCH, now())
    return plain(companies, "load_timestamp")


# Dimension


@query
def company_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.company_input(inputs.incoming_frames(spark, sf_dir))


def _next_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.apply_scd2(
        inputs.dimension(spark, sf_dir), inputs.incoming(spark, sf_dir), now()
    )


@query
def scd2_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_next_dimension(spark, sf_dir))


@query
def scd2_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = scd2.current(inputs.dimension(spark, sf_dir))
    return scd2.stats(scd2.classify(stored, inputs.incoming(spark, sf_dir)))


@query
def scd2_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loading the same batch again meets its own names and changes nothing."""
    stored = scd2.current(_next_dimension(spark, sf_dir))
    return scd2.stats(scd2.classify(stored, inputs.incoming(spark, sf_dir)))


@query
def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(views.company_history(_next_dimension(spark, sf_dir)))


@query
def scd2_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.expr("'C' || CAST(o_custkey AS STRING)").alias("company_id"), "o_orderdate"
    )
    named = scd2.as_of(orders, inputs.dimension(spark, sf_dir), "o_orderdate")
    return named.select("o_orderkey", "company_id", "version_sk", "name_at_time")


@query
def dim_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(scd2.current(inputs.dimension(spark, sf_dir)))


@query
def dim_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.version_counts(_next_dimension(spark, sf_dir))


@query
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates.date_dimension_of(table(spark, sf_dir, "orders"), "o_orderdate")


# Facts


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = scd2.current(inputs.dimension(spark, sf_dir))
    return facts.project_fact(
        facts.resolve_keys(_staged(spark, sf_dir), stored), BATCH, now()
    )


@query
def fact_sk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(_facts(spark, sf_dir))


@query
def fact_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.resolution_counts(_facts(spark, sf_dir))


KEY_INPUT = ("line_id", "company_id", "period", "source_file", "order_status")


def _keys(lines: DataFrame) -> DataFrame:
    return mapping.apply_rules(
        lines, [MappingRule("period", "period_type", "map_cy_py", "varchar")], DEFAULT_RATES
    ).select("line_id", *facts.FACT_KEYS)


def _incremental(
    spark: SparkSession, sf_dir: str, null_safe: bool, scope: str | None = None
) -> DataFrame:
    lines = inputs.ledger(spark, sf_dir, *KEY_INPUT)
    existing = _keys(lines.where("order_status = 'F'"))
    return facts.incremental(_keys(lines), existing, null_safe=null_safe, scope=scope)


@query
def fact_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _incremental(spark, sf_dir, null_safe=False)


@query
def fact_incremental_nullsafe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _incremental(spark, sf_dir, null_safe=True)


@query
def fact_incremental_scoped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _incremental(spark, sf_dir, null_safe=False, scope="source_file")


@query
def fact_incremental_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known rows looked for only where a summary of each folder's keys has something in common with the new ones."""
    lines = inputs.ledger(spark, sf_dir, *KEY_INPUT)
    new = _keys(lines)
    existing = _keys(lines.where("order_status = 'F'")).withColumn("folder", F.pmod(F.xxhash64("source_file", "company_id"), F.lit(64)))
    may_hold = facts.folders_with_keys(new, facts.key_summary(existing, ["folder"]), ["folder"])
    return facts.incremental(new, existing.join(may_hold, "folder", "left_semi").drop("folder"))


@query
def load_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five parsed sources through validation, shaping and staging to new facts.

    Orders of status F count as loaded before.
    """
    sources = {
        "xbrl_xml": xml_periods(spark, sf_dir),
        "hierarchical_xml": xml_hierarchical(spark, sf_dir),
        "financials_json": json_nested(spark, sf_dir),
        "period_json": json_periods(spark, sf_dir),
        "complex_csv": csv_sections(spark, sf_dir),
    }
    staged = []
    for name, rows in sources.items():
        valid, _ = quality.validate(rows)
        if name == "complex_csv":
            valid = quality.remove_duplicates(valid, ["company_id", "year"])
        shaped = shape(valid, name, DEFAULT_RULES, DEFAULT_RATES)
        staged.append(conforming.stage_financials(shaped, BATCH, now()))
    existing = _keys(inputs.ledger(spark, sf_dir, *KEY_INPUT).where("order_status = 'F'")).withColumn(
        "source_file", F.replace(F.replace("source_file", F.lit("ledger"), F.lit("filing")),
                                 F.lit(".csv"), F.lit(".xml"))
    )
    stored = scd2.current(inputs.dimension(spark, sf_dir))
    new = facts.new_facts(conforming.stack(staged), stored, existing, BATCH, now())
    return new.groupBy("source_file", "period_type").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.count("dim_company_sk").alias("resolved"),
        F.sum("year").alias("sum_year"),
        F.sum(F.col("revenue_usd") * 100).cast("bigint").alias("usd_cents"),
        F.sum("profit").cast("bigint").alias("profit"),
    )


@query
def period_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.period_distribution(_facts(spark, sf_dir))


# Views


@query
def view_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = views.company_summary(_facts(spark, sf_dir), inputs.dimension(spark, sf_dir))
    return plain(summary)


@query
def view_summary_by_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a rename the surrogate-key view loses older facts; by company it does not."""
    renamed = _next_dimension(spark, sf_dir)
    summary = views.company_summary(_facts(spark, sf_dir), renamed, by="business_key")
    return plain(summary)


@query
def view_summary_after_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(views.company_summary(_facts(spark, sf_dir), _next_dimension(spark, sf_dir)))


@query
def view_revenue_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = views.revenue_comparison(_facts(spark, sf_dir), inputs.dimension(spark, sf_dir))
    return plain(compared)


@query
def view_revenue_comparison_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenues summed per company and file before they are compared."""
    compared = views.revenue_comparison(_facts(spark, sf_dir), inputs.dimension(spark, sf_dir), grain="company_file")
    return plain(compared)
