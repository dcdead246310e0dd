"""Readers for the two XML shapes.

A reader has two halves: one finds elements in files, the other turns elements
into rows. The default finds elements by reading text up to each closing tag,
which Spark splits like any text file, so one huge single-line document is read
by many tasks. The tag's namespace prefix is that of the root, which is looked up in the
first lines of a source. ``splittable=false`` uses Spark's XML source, one task per file.

A chunk of text that is one element and nothing else, as nearly all are, says nothing about the
document around it. The others are told apart: the element in them, and what stands outside of it
(``marks``). Per file, the marks show whether the document is closed and where its elements
stand. A batch writes rows and marks in one pass and looks at the marks that were written;
a reader by itself looks at them in a second, lighter branch.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.config import Source
from ledgerloom.functions import blank_to_null

#: Tags of a source among which the root is looked for.
HEAD = 64
PERIOD_TAG = "entity"
# Every child is a list: of a repeated child the first counts, except for ``financials``.
PERIOD_SCHEMA = (
    "identifier array<string>, "
    "financials array<struct<_period: string, revenue: array<string>, profit: array<string>>>"
)
COMPANY_TAG = "Company"
COMPANY_SCHEMA = (
    "CompanyID array<string>, Details array<struct<Name: array<string>, "
    "Financials: array<struct<Revenue: array<string>, Year: array<string>>>>>"
)
# A document that is not well formed fails its source, as a whole.
PARSING = {"mode": "FAILFAST", "ignoreNamespace": "true"}


def root_prefix(head: str) -> str | None:
    """Namespace prefix of the root element of a document that begins with this text; None without one."""
    found = re.match(r"(?s)\ufeff?(?:\s+|<\?.*?\?>|<!--.*?-->|<!DOCTYPE[^\[>]*(?:\[.*?\]\s*)?>)*<([^\s<>/:!?]+):[^\s<>/:]+", head)
    return found and found[1]


def find_prefix(spark: SparkSession, source: Source) -> str | None:
    """The prefix in use: the option ``prefix`` (empty: none), else that of the root of a file.

    Only the first ``HEAD`` tags of the source are read. Other files must have the same prefix; that
    is checked where elements are found.
    """
    if "prefix" in source.options:
        return source.options["prefix"] or None
    tags = spark.read.text(source.path, lineSep=">").select("value").limit(HEAD).collect()
    return root_prefix("".join(f"{t.value}>" for t in tags))


def element_texts(spark: SparkSession, path: str, tag: str, prefix: str | None = None) -> DataFrame:
    """One row per element: its text and its file. ``prefix`` is a namespace prefix in use."""
    return split_elements(_chunks(spark, path, _named(tag, prefix)), tag, prefix)


def _chunks(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.text(path, lineSep=f"</{name}>").select(
        F.col("value").alias("chunk"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("source_file"))


def _named(tag: str, prefix: str | None) -> str:
    return f"{prefix}:{tag}" if prefix else tag


def _plainly_alone(name: str, tag: str) -> Column:
    """Whether a chunk begins as an element without attributes and doesn't name the tag again: one element, told without a pattern."""
    start, text = f"<{name}>", F.ltrim(F.col("chunk"), F.lit(" \t\r\n"))
    return text.startswith(start) & ~F.substr(text, F.lit(len(start) + 1)).contains(tag)


def _alone(name: str, tag: str) -> Column:
    """Whether a chunk is the start of one element, and nothing stands before or between."""
    return _plainly_alone(name, tag) | F.col("chunk").rlike(rf"^\s*<{name}[\s>]") & (F.regexp_count("chunk", F.lit(rf"<(?:[^<>/\s:]+:)?{tag}[\s>]")) == 1)


def tagged_elements(chunks: DataFrame, tag: str, prefix: str | None = None) -> DataFrame:
    """One pass over documents that were cut at the element's closing tag: ``element, marks, file, source_file``.

    Needs ``chunk, file, source_file``; without ``file`` the name stands for it. A chunk gives an element, marks of
    what stands outside of it, or both. Whatever this textual split could get wrong is an
    error, never a lost or invented row: another encoding than UTF-8, another prefix, a
    closing tag with blanks, a commented-out element.
    """
    name = _named(tag, prefix)
    if "file" not in chunks.columns:
        chunks = chunks.withColumn("file", F.col("source_file"))
    chunk = F.col("chunk")
    # Whole comments hold nothing; what begins one that goes on in another chunk stays.
    text = F.regexp_replace(chunk, r"(?s)(<!\[CDATA\[.*?\]\]>)|<!--.*?-->", "$1")
    found = F.regexp_extract(text, rf"(?s)^.*(<{name}[\s>].*)$", 1)
    encoding = F.lower(F.regexp_extract(chunk, r"""^[\s\uFEFF]*<\?xml[^>]*?encoding\s*=\s*["']([^"']+)""", 1))
    hint = "set splittable=false"
    unsafe = (
        F.when(~encoding.isin("", "utf-8", "utf8", "us-ascii", "ascii"), F.concat(F.lit("document is encoded as "), encoding, F.lit(f": {hint}")))
        .when(
            text.rlike(rf"<[^<>/\s:]+:{tag}[\s>]") if prefix is None else text.rlike(rf"<(?!{prefix}:)(?:[^<>/\s:]+:)?{tag}[\s>]"),
            F.lit(f"{tag} elements with another namespace prefix than the first file's root: set option prefix or splittable=false"),
        )
        .when(F.regexp_count(text, F.lit(rf"<{name}[\s>]")) > 1, F.lit(f"unusual closing tag of {tag}: {hint}"))
        .when(text.contains("<!--") & text.rlike(rf"(?s)<!--.*<{name}[\s>]"), F.lit(f"{tag} inside a comment: {hint}"))
    )
    alone = _alone(name, tag)
    # No expression below the first case is computed for a chunk that is one element.
    checked = F.when(alone, F.ltrim("chunk")).when(unsafe.isNotNull(), F.raise_error(unsafe).cast("string")).otherwise(found)
    parts = chunks.select("file", "source_file", checked.alias("element"), F.when(~alone, chunk).alias("chunk"))
    return _marked(parts, name).select(
        F.when(F.col("element") != "", F.concat("element", F.lit(f"</{name}>"))).alias("element"), "marks", "file", "source_file",
    ).where("element IS NOT NULL OR marks IS NOT NULL")


def _marked(chunks: DataFrame, name: str) -> DataFrame:
    """Marks of what stands outside of elements in ``chunk`` (NULL: nothing): tags opened beyond those closed, the root's end, any text."""
    plain = F.regexp_replace("chunk", r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<[?!][^>]*>", "")
    parts = chunks.withColumn("plain", plain).withColumn("outside", F.regexp_replace("plain", rf"(?s)<{name}[\s>].*$", ""))
    opened = F.regexp_count("outside", F.lit(r"<[^/<>](?:[^<>]*[^/<>])?>")) - F.regexp_count("outside", F.lit("</"))
    tail = (F.col("outside") == F.col("plain")) & F.col("plain").rlike(r"(?:</[^<>]+|/)>\s*$")
    marks = F.struct(opened.alias("opened"), tail.alias("tail"), F.col("plain").rlike(r"\S").alias("written"))
    return parts.withColumn("marks", F.when(F.col("outside").isNotNull(), marks)).drop("plain", "outside")


def broken_documents(marked: DataFrame, tag: str) -> DataFrame:
    """``problem, source_file`` of documents that end too early or hold elements that aren't children of the root.

    Needs ``marks, file, source_file`` of every chunk that has marks, and a row of each file. What
    stands outside of the elements opens and closes the root: over a whole document its tags are level, and
    only the root is ever opened around an element. The last chunk holds no element and closes the root.
    """
    files = marked.groupBy("file").agg(
        F.coalesce(F.bool_or("marks.tail"), F.lit(False)).alias("closed"), F.coalesce(F.sum("marks.opened"), F.lit(0)).alias("level"),
        F.sum(F.greatest("marks.opened", F.lit(0))).alias("around"), F.bool_or(F.coalesce("marks.written", F.lit(True))).alias("written"),
        F.first("source_file").alias("source_file"),
    )
    problem = F.when(~F.col("closed") | (F.col("level") != 0), "XML ends too early: ").when(
        F.col("around") > 1, f"{tag} below another element, set splittable=false: ")
    return files.where("written").select(F.concat(problem, "file").alias("problem"), "source_file").where("problem IS NOT NULL")


def split_elements(chunks: DataFrame, tag: str, prefix: str | None = None) -> DataFrame:
    """``element, source_file`` of every element (see ``tagged_elements``); a broken document is an error."""
    tagged = tagged_elements(chunks, tag, prefix)
    wrong = broken_documents(tagged, tag).select(F.raise_error(F.col("problem")).cast("string").alias("element"), "source_file")
    return tagged.where("element IS NOT NULL").select("element", "source_file").unionByName(wrong)


def _elements(spark: SparkSession, source: Source, tag: str, schema: str) -> DataFrame:
    """Parsed elements as struct column ``item`` with ``source_file``."""
    prefix = find_prefix(spark, source)
    if source.flag("splittable", True):
        return parse_elements(element_texts(spark, source.path, tag, prefix), schema)
    rows = spark.read.format("xml").options(rowTag=tag, **PARSING).schema(schema).load(source.path)
    items = rows.select(F.struct(*rows.columns).alias("item"), F.col("_metadata.file_name").alias("source_file"))
    # Spark's source takes what it finds of a document that ends too early.
    chunks = _chunks(spark, source.path, _named(tag, prefix))
    wrong = broken_documents(_marked(chunks, _named(tag, prefix)), tag)
    broken = wrong.select(F.raise_error(F.col("problem")).cast("string").alias("element"), "source_file")
    return items.unionByName(parse_elements(broken, schema))


MARKS = "XML_MARKS; "


def _outcomes(spark: SparkSession, source: Source, tag: str, schema: str, rows: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Rows of all elements, and one record for each chunk with marks (reason ``MARKS``), in one pass over the files."""
    if not source.flag("splittable", True):
        return rows(_elements(spark, source, tag, schema)).withColumns({c: F.lit(None).cast("string") for c in ("record_data", "rejection_reason")})
    prefix = find_prefix(spark, source)
    tagged = tagged_elements(_chunks(spark, source.path, _named(tag, prefix)), tag, prefix)
    marks = F.when(F.col("marks").isNotNull(), F.to_json(F.struct("file", "marks.*")))
    return rows(parse_elements(tagged.withColumn("record_data", marks), schema, "record_data")).withColumn(
        "rejection_reason", F.when(F.col("record_data").isNotNull(), F.lit(MARKS)))


def check(tag: str) -> Callable[[Source, DataFrame, DataFrame], DataFrame]:
    """What finds broken documents among a batch's stored marks (record_data, source_file) and rows."""
    def problems(source: Source, marks: DataFrame, rows: DataFrame) -> DataFrame:
        fields = "file string, opened int, tail boolean, written boolean"
        found = marks.select(F.from_json("record_data", fields).alias("marks"), "source_file").withColumn("file", F.col("marks.file"))
        broken = broken_documents(found, tag)
        if not source.flag("splittable", True):
            return broken
        bare = rows.select("source_file").distinct().join(found, "source_file", "left_anti")
        return broken.unionByName(bare.select(F.concat(F.lit("XML without a root element: "), "source_file").alias("problem"), "source_file"))

    return problems


def parse_elements(texts: DataFrame, schema: str, *kept: str) -> DataFrame:
    return texts.select(F.from_xml("element", schema, PARSING).alias("item"), "source_file", *kept)


def _first(column: str) -> Column:
    """The first of a repeated child, NULL without any."""
    return F.get(F.col(column), F.lit(0))


def _with_marks(rows: Column, empty: str) -> Column:
    """The rows of an element and, if its chunk has marks, one more without values."""
    none = F.array().cast(f"array<struct<{empty}>>")
    marked = F.when(F.col("record_data").isNotNull(), F.array(F.lit(None).cast(f"struct<{empty}>"))).otherwise(none)
    return F.explode(F.concat(F.coalesce(rows.cast(f"array<struct<{empty}>>"), none), marked))


def _lines(elements: DataFrame, rows: Column, fields: str) -> DataFrame:
    """One row per entry of ``rows``; of outcomes (elements with record_data) also one per chunk with marks."""
    if "record_data" not in elements.columns:
        return elements.select(F.inline(rows), "source_file")
    each = elements.select(_with_marks(rows, fields).alias("r"), "source_file", "record_data")
    return each.select("r.*", "source_file", F.when(F.col("r").isNull(), F.col("record_data")).alias("record_data"))


def period_rows(elements: DataFrame) -> DataFrame:
    """One row per entity and ``financials`` child; an entity without any gives no row."""
    rows = F.transform("item.financials", lambda f: F.struct(
        blank_to_null(_first("item.identifier")).alias("company_id"), F.coalesce(f["_period"], F.lit("UNKNOWN")).alias("period"),
        blank_to_null(F.get(f["revenue"], F.lit(0))).alias("revenue"), blank_to_null(F.get(f["profit"], F.lit(0))).alias("profit")))
    return _lines(elements, rows, "company_id: string, period: string, revenue: string, profit: string").select(
        "company_id", "period", "revenue", "profit", "source_file", *(c for c in ("record_data",) if c in elements.columns))


def company_rows(elements: DataFrame) -> DataFrame:
    """One row per company that has financial details."""
    details = _first("item.Details")
    financials = F.get(details["Financials"], F.lit(0))
    row = F.struct(
        blank_to_null(_first("item.CompanyID")).alias("company_id"), blank_to_null(F.get(details["Name"], F.lit(0))).alias("company_name"),
        blank_to_null(F.get(financials["Revenue"], F.lit(0))).alias("revenue"), blank_to_null(F.get(financials["Year"], F.lit(0))).alias("year"))
    return _lines(
        elements, F.when(financials.isNotNull(), F.array(row)), "company_id: string, company_name: string, revenue: string, year: string",
    ).select("company_id", "company_name", "revenue", "year", "source_file", *(c for c in ("record_data",) if c in elements.columns))


def read_periods(spark: SparkSession, source: Source) -> DataFrame:
    return period_rows(_elements(spark, source, PERIOD_TAG, PERIOD_SCHEMA))


def read_companies(spark: SparkSession, source: Source) -> DataFrame:
    return company_rows(_elements(spark, source, COMPANY_TAG, COMPANY_SCHEMA))


def read_period_outcomes(spark: SparkSession, source: Source) -> DataFrame:
    return _outcomes(spark, source, PERIOD_TAG, PERIOD_SCHEMA, period_rows)


def read_company_outcomes(spark: SparkSession, source: Source) -> DataFrame:
    return _outcomes(spark, source, COMPANY_TAG, COMPANY_SCHEMA, company_rows)
