"""Readers for the two JSON shapes.

Values are read as VARIANT, because what a value turns into depends on its JSON
type: the number 0 counts as absent, the text "0" does not; a missing object gives
a row of NULLs, an explicit ``null`` drops the record. Elements that give no row are
reported by the readers of rejects, with the reason. An object with a repeated key needs
``spark.sql.variant.allowDuplicateKeys``, which a batch run sets; its last value counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.config import Source
from ledgerloom.functions import file_name
from ledgerloom.sources import json_split

# The two periods of a record, in output order.
PERIODS = ("CY", "PY")
NESTED_LEAVES = ("company_id", "year", "revenue", "currency")
#: What an outcome has besides a row's columns: the record as JSON and the reason, both NULL of a row.
REJECT_COLUMNS = ("record_data", "rejection_reason")


def member(value: Column, name: str) -> Column:
    """Member of an object as VARIANT; SQL NULL when there is none."""
    return F.try_variant_get(value, f"$.{name}", "variant")


def kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def is_object(value: Column, *members: Column) -> Column:
    """Missing or an object. Anything else (null, text, list) cannot be descended into.

    A value one of whose ``members`` was found is an object; only otherwise is its
    type looked up, which walks the whole value.
    """
    known = F.when(value.isNull(), True)
    for found in members:
        known = known.when(found.isNotNull(), True)
    return known.otherwise(kind(value).startswith("OBJECT"))


def _fractional(plain: Column, sort: Column) -> Column:
    # 100.0 is kept as a decimal of scale 0; a whole number that short would be a BIGINT.
    whole = sort.rlike(r"^DECIMAL\((\d|1[0-8]),0\)$")
    shown = F.when(whole, F.concat(plain, F.lit(".0"))).otherwise(plain)
    return F.when(plain.try_cast("double") != 0, shown)


def text_of(plain: Column, sort: Column) -> Column:
    """Text of a value from its plain string and its kind.

    0, false, empty text, empty containers and null become NULL.
    """
    return (
        F.when(sort == "STRING", F.nullif(plain, F.lit("")))
        .when(sort == "BIGINT", F.nullif(plain, F.lit("0")))
        .when(sort == "BOOLEAN", F.when(plain == "true", F.lit("True")))
        .when(sort.startswith("DECIMAL") | sort.isin("DOUBLE", "FLOAT"), _fractional(plain, sort))
        .when(sort.startswith("OBJECT") | sort.startswith("ARRAY"),
              F.when(~plain.isin("{}", "[]"), plain))
    )


def with_texts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace VARIANT columns by their text.

    In two projections: each value is looked up once, not once per branch.
    """
    kept = [c for c in df.columns if c not in names]
    looked_up = df.select(
        *kept,
        *(F.try_variant_get(F.col(n), "$", "string").alias(f"_{n}_plain") for n in names),
        *(kind(F.col(n)).alias(f"_{n}_kind") for n in names),
    )
    texts = {n: text_of(F.col(f"_{n}_plain"), F.col(f"_{n}_kind")) for n in names}
    return looked_up.select(*kept, *(text.alias(n) for n, text in texts.items()))


def _nested(records: DataFrame) -> DataFrame:
    """VARIANT leaves of ``company``, and whether all objects on the way to them can be descended into (``usable``)."""
    kept = [c for c in records.columns if c != "company"]
    outer = records.select(
        *kept, "company",
        member(F.col("company"), "company_id").alias("company_id"),
        member(F.col("company"), "details").alias("details"),
    )
    middle = outer.withColumns({
        "year": member(F.col("details"), "year"),
        "financials": member(F.col("details"), "financials"),
    })
    inner = middle.withColumns({
        "revenue": member(F.col("financials"), "revenue"),
        "currency": member(F.col("financials"), "currency"),
    })
    usable = (
        is_object(F.col("company"), F.col("company_id"), F.col("details"))
        & is_object(F.col("details"), F.col("year"), F.col("financials"))
        & is_object(F.col("financials"), F.col("revenue"), F.col("currency"))
    )
    return inner.select(*kept, *NESTED_LEAVES, usable.alias("usable"))


def nested_rows(records: DataFrame) -> DataFrame:
    """``company.details.financials`` flattened. Needs VARIANT ``company`` and ``source_file``."""
    # A generator instead of a filter: a filter would be pushed below and repeat the lookups.
    rows = _nested(records).select("source_file", F.inline(F.when(F.col("usable"), F.array(F.struct(*NESTED_LEAVES)))))
    return with_texts(rows, NESTED_LEAVES).select(*NESTED_LEAVES, "source_file")


def _periods(records: DataFrame) -> DataFrame:
    """VARIANT rows of both periods, and whether the first (``opened``) and the second (``both``) can be descended into."""
    current, previous = (F.col(p) for p in PERIODS)
    kept = [c for c in records.columns if c != "financials"]
    each = records.select(
        *kept, "financials",
        *(member(F.col("financials"), p).alias(p) for p in PERIODS),
    ).withColumns({f"{p}_revenue": member(F.col(p), "revenue") for p in PERIODS})
    opened = is_object(F.col("financials"), current, previous) & is_object(current, F.col("CY_revenue"))
    return each.select(*kept, *(f"{p}_revenue" for p in PERIODS), opened.alias("opened"), is_object(previous, F.col("PY_revenue")).alias("both"))


def _period(name: str, *more: Column) -> Column:
    return F.struct("company_id", F.lit(name).alias("period"), F.col(f"{name}_revenue").alias("revenue"), *more)


def period_rows(records: DataFrame) -> DataFrame:
    """Two rows per record, CY then PY, also where a period is absent.

    Needs VARIANT ``company_id`` and ``financials`` and ``source_file``. A period
    that is no object ends its record there: an unusable PY leaves the CY row.
    """
    rows = F.when(F.col("opened") & F.col("both"), F.array(*map(_period, PERIODS))).when(F.col("opened"), F.array(_period("CY")))
    texts = with_texts(_periods(records).select("source_file", F.inline(rows)), ["company_id", "revenue"])
    return texts.select("company_id", "period", "revenue", "source_file")


def parse_records(texts: DataFrame, members: Sequence[str]) -> DataFrame:
    """Members of ``record`` texts as VARIANT columns. Broken JSON fails the source."""
    parsed = texts.select("source_file", F.parse_json("record").alias("_record"))
    return parsed.select("source_file", *(member(F.col("_record"), m).alias(m) for m in members))


def parse_elements(runs: DataFrame, inside: bool = False) -> DataFrame:
    """Each element of runs (see ``split_elements``) as VARIANT ``element``. Broken JSON fails the source.

    A file that holds one object or one other value, but no list and no lines, gives one row
    with ``no_list`` set: the value if it is short, else the file's name. ``inside``: the
    runs come from within a list.
    """
    text, shape = F.col("text"), F.lit(json_split.LIST) if inside else F.col("shape")
    bare = F.regexp_replace(text, r"^[\s\uFEFF]*[\[,]", "")
    bare = F.when(F.col("last") & F.lit(not inside), F.regexp_replace(bare, r"\]\s*$", "")).otherwise(bare)
    lines = F.filter(F.split(F.regexp_replace(text, r"^\uFEFF", ""), "\n"), lambda line: line.rlike(r"\S"))
    name = F.to_json(F.struct("source_file"))
    # Texts to parse: one of all elements of a run, or one for each line.
    texts = (
        F.when(shape == json_split.LIST, F.array(F.concat(F.lit("["), bare, F.lit("]"))))
        .when(shape == json_split.OBJECT, F.array(name))
        .when(text.isNull(), F.when(shape == json_split.SCALAR, F.array(name)).otherwise(F.array().cast("array<string>")))
        .otherwise(lines)
    )
    each = runs.select("source_file", shape.alias("shape"), texts.alias("texts")).select(
        "source_file", (F.col("shape") == json_split.LIST).alias("listed"), _no_list(F.col("shape")).alias("no_list"), F.explode("texts").alias("text"))
    parsed = each.select("source_file", "listed", "no_list", F.parse_json("text").alias("value"))
    elements = F.when(F.col("listed"), F.try_variant_get("value", "$", "array<variant>")).otherwise(F.array("value"))
    return parsed.select("source_file", "no_list", F.explode(elements).alias("element"))


def _no_list(shape: Column) -> Column:
    """Whether a run of this shape is all of a file that is neither a list nor lines."""
    return (shape == json_split.OBJECT) | ((shape == json_split.SCALAR) & (F.size("texts") == 1))


def read_elements(spark: SparkSession, source: Source) -> DataFrame:
    """Every element of JSON files, read by many tasks per file.

    A file is a list, or holds one value per line; each file shows which. With ``lines=true`` each line is
    an element, also in a file of one line.
    """
    if source.flag("lines", False):
        lines = spark.read.text(source.path).where(F.col("value").rlike(r"\S"))
        return lines.select(
            F.col("_metadata.file_name").alias("source_file"), F.lit(False).alias("no_list"),
            F.parse_json("value").alias("element"))
    runs = json_split.read_elements(spark, source.path)
    return parse_elements(runs.withColumn("source_file", file_name(F.col("file"))))


def records_of(elements: DataFrame, members: Sequence[str]) -> DataFrame:
    """Members of the elements that are objects."""
    objects = elements.where(~F.col("no_list") & kind(F.col("element")).startswith("OBJECT"))
    return objects.select("source_file", *(member(F.col("element"), m).alias(m) for m in members))


NO_LIST, NO_OBJECT, UNUSABLE = "NO_JSON_LIST; ", "NO_JSON_OBJECT; ", "UNUSABLE_RECORD; "


def _opened(elements: DataFrame, members: Sequence[str]) -> DataFrame:
    """Members of every element, and why it can't be a record (NULL if it is an object)."""
    reason = F.when(F.col("no_list"), NO_LIST).when(~kind(F.col("element")).startswith("OBJECT"), NO_OBJECT)
    return elements.select(
        "source_file", "element", reason.alias("unfit"), *(member(F.col("element"), m).alias(m) for m in members))


def _record_data() -> Column:
    return F.when(F.col("rejection_reason").isNotNull(), F.to_json("element")).alias("record_data")


def nested_outcomes(elements: DataFrame) -> DataFrame:
    """What becomes of every element, from one pass: a row as in ``nested_rows``, or a reject with its reason."""
    leaves = _nested(_opened(elements, ["company"]))
    reason = F.coalesce("unfit", F.when(~F.col("usable"), UNUSABLE))
    marked = leaves.withColumn("rejection_reason", reason)
    fit = {n: F.when(F.col("rejection_reason").isNull(), F.col(n)) for n in NESTED_LEAVES}
    texts = with_texts(marked.select("source_file", "rejection_reason", _record_data(), *(c.alias(n) for n, c in fit.items())), NESTED_LEAVES)
    return texts.select(*NESTED_LEAVES, "source_file", *REJECT_COLUMNS)


def period_outcomes(elements: DataFrame) -> DataFrame:
    """What becomes of every element, from one pass: rows as in ``period_rows``, or a reject; after an unusable PY both."""
    each = _periods(_opened(elements, ["company_id", "financials"]))
    none, reason = F.lit(None).cast("string"), F.lit(UNUSABLE)
    no_value = F.lit(None).cast("variant")

    def reject(why: Column) -> Column:
        return F.struct(no_value.alias("company_id"), none.alias("period"), no_value.alias("revenue"), why.alias("rejection_reason"))

    kept = none.alias("rejection_reason")
    rows = (
        F.when(F.col("unfit").isNotNull(), F.array(reject(F.col("unfit"))))
        .when(F.col("opened") & F.col("both"), F.array(*(_period(p, kept) for p in PERIODS)))
        .when(F.col("opened"), F.array(_period("CY", kept), reject(reason)))
        .otherwise(F.array(reject(reason)))
    )
    marked = each.select("source_file", "element", F.inline(rows))
    texts = with_texts(
        marked.select("source_file", "rejection_reason", _record_data(), "company_id", "period", "revenue"), ["company_id", "revenue"])
    return texts.select("company_id", "period", "revenue", "source_file", *REJECT_COLUMNS)


def rows_of(outcomes: DataFrame) -> DataFrame:
    return outcomes.where("rejection_reason IS NULL").drop(*REJECT_COLUMNS)


def rejects_of(outcomes: DataFrame) -> DataFrame:
    return outcomes.where("rejection_reason IS NOT NULL").select(*REJECT_COLUMNS, "source_file")


def read_nested_outcomes(spark: SparkSession, source: Source) -> DataFrame:
    return nested_outcomes(read_elements(spark, source))


def read_period_outcomes(spark: SparkSession, source: Source) -> DataFrame:
    return period_outcomes(read_elements(spark, source))


def read_nested(spark: SparkSession, source: Source) -> DataFrame:
    return nested_rows(records_of(read_elements(spark, source), ["company"]))


def read_periods(spark: SparkSession, source: Source) -> DataFrame:
    return period_rows(records_of(read_elements(spark, source), ["company_id", "financials"]))


def nested_rejects(spark: SparkSession, source: Source) -> DataFrame:
    return rejects_of(read_nested_outcomes(spark, source))


def period_rejects(spark: SparkSession, source: Source) -> DataFrame:
    return rejects_of(read_period_outcomes(spark, source))
