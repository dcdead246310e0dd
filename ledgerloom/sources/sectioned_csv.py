"""Reader for CSV files that hold several tables and metadata lines.

Which table a line belongs to depends on all lines before it. Instead of one task
walking a file, each block of a file (see ``ordered_text``) is scanned on its own,
relative to its unknown start; a block then shrinks to one summary row, the
summaries of a file are scanned in order, and each block gets the state it starts
in. A file of any size is read by as many tasks as it has blocks.

A cell in quotes may hold line breaks, so before that lines are put together to records, in the
same way: a line maps the state it starts in (outside or inside a quoted cell) to the state it ends in,
these maps compose to one for each block, and the blocks of a file are gone through in order.
What a record has of lines is gathered in its block; what it has in later blocks comes
with the summary of those. ``multiline_cells=false`` leaves that out where no cell has breaks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.config import Source
from ledgerloom.functions import file_name, strip
from ledgerloom.functions.text import WHITESPACE
from ledgerloom.sources.ordered_text import ordered_lines, placed_only

# Column names that make a header, and labels that make a metadata line.
KNOWN_COLUMNS = ("company_id", "profit", "year", "remarks")
METADATA_LABELS = ("enity name", "entity name", "period start date", "period end date")

BLANK, META, HEADER, DATA = "blank", "meta", "header", "data"

# A quoted cell: quotes inside are doubled, text after the closing quote is kept.
QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
CELL = rf'(?:{QUOTED}"?[^,]*|[^,]*)'
OPEN_CELL = rf'^(?:(?:[^",][^,]*|{QUOTED}"(?:[^",][^,]*)?)?,)*+{QUOTED}$'
#: Characters of a cell beyond which its file is taken to be broken, as by a quote that never closes.
MOST_CHARS = 131_072


def _unquote(cell: Column) -> Column:
    inner = F.regexp_extract(cell, rf'(?s)^"([^"]*+(?:""[^"]*+)*+)', 1)
    rest = F.regexp_extract(cell, rf'(?s)^{QUOTED}"(.*)$', 1)
    return F.when(
        cell.startswith('"'), F.concat(F.replace(inner, F.lit('""'), F.lit('"')), rest)
    ).otherwise(cell)


def cells(line: Column) -> Column:
    """Cells of a CSV line, stripped. Lines without quote or white space take the short way."""
    quoted = F.transform(
        F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(f",({CELL})"), 1), _unquote
    )
    raw = F.when(line.contains('"'), quoted).otherwise(F.split(line, ",", -1))
    return F.when(line.rlike(f"[{WHITESPACE}]"), F.transform(raw, strip)).otherwise(raw)


def csv_lines(spark: SparkSession, source: Source) -> DataFrame:
    """Ordered records of a source: lines, and with ``multiline_cells`` (default) the lines of one record together."""
    if source.flag("multiline_cells", True):
        lines = ordered_lines(spark, source.path, line_sep="\n").drop("size")
        # A return that stands alone ends a line, too.
        ended = F.concat("line", F.lit("\n"))
        parts = F.when(F.col("line").contains("\r") & F.col("line").rlike(r"(?s)\r."), F.split(ended, r"(?<=\r)(?!\n)")).otherwise(F.array(ended))
        single = lines.select("file", "block", F.explode(parts).alias("line"))
        return records(single.withColumn("pos", F.monotonically_increasing_id()))
    lines = ordered_lines(spark, source.path).drop("size")
    spans = F.col("line").contains('"') & F.col("line").rlike(OPEN_CELL)
    message = F.concat(F.lit("cell spans lines, leave multiline_cells at true: "), "file")
    return lines.withColumn("line", F.when(spans, F.raise_error(message).cast("string")).otherwise(F.col("line")))


def _without_end(line: Column) -> Column:
    """A line without what ends it: one return, feed, or both."""
    size = F.when(line.endswith("\r\n"), 2).when(line.endswith("\n") | line.endswith("\r"), 1)
    return F.when(size.isNull(), line).otherwise(F.left(line, F.length(line) - size))


def _states(lines: DataFrame) -> DataFrame:
    """Per line, the state before it and after it, relative to that at the start of its block.

    A line either keeps the state, swaps it, or ends in a fixed one (``fixed``). The state after some
    lines is the last fixed one, if any, swapped as often as a line after it swaps.
    """
    quoted = F.col("line").contains('"')
    text = _without_end(F.col("line"))
    ends_0 = F.when(quoted, text.rlike(OPEN_CELL)).otherwise(False).cast("int")
    ends_1 = F.when(quoted, F.concat(F.lit('"'), text).rlike(OPEN_CELL)).otherwise(True).cast("int")
    mapped = lines.select(
        "file", "block", "pos", "line",
        ((ends_0 == 1) & (ends_1 == 0)).cast("int").alias("swaps"), F.when(ends_0 == ends_1, ends_0).alias("fixed"))
    ordered = Window.partitionBy("file", "block").orderBy("pos")
    so_far, before = (ordered.rowsBetween(Window.unboundedPreceding, last) for last in (Window.currentRow, -1))
    summed = mapped.withColumn("swapped", F.sum("swaps").over(so_far))
    last = F.when(F.col("fixed").isNotNull(), F.struct("fixed", "swapped"))
    return summed.withColumns({
        "last_after": F.last(last, ignorenulls=True).over(so_far), "last_before": F.last(last, ignorenulls=True).over(before),
    })


def _state(start: Column, last: Column, swapped: Column) -> Column:
    """State after some lines: ``last`` fixed one among them and the swaps up to it, ``swapped`` in all."""
    return F.when(last.isNull(), (start + swapped) % 2).otherwise((last["fixed"] + swapped - last["swapped"]) % 2)


def records(lines: DataFrame) -> DataFrame:
    """Records of ordered lines, with the same columns: the lines of a record in a row, at the place of the first.

    Lines still have what ends them; records don't.
    """
    states = _states(placed_only(lines))
    blocks = states.groupBy("file", "block").agg(F.max("swapped").alias("swapped"), F.max_by("last_after", "pos").alias("last"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    summed = blocks.withColumn("before", F.coalesce(F.sum("swapped").over(earlier), F.lit(0)))
    # The same composition again, over blocks: the last one with a fixed state, and the swaps since.
    fixed = F.when(F.col("last").isNotNull(), F.struct(_state(F.lit(0), F.col("last"), F.col("swapped")).alias("fixed"), (F.col("before") + F.col("swapped")).alias("swapped")))
    starts = summed.withColumn("start", _state(F.lit(0), F.last(fixed, ignorenulls=True).over(earlier), F.col("before"))).select("file", "block", "start")
    placed = states.join(starts, ["file", "block"]).select(
        "file", "block", "pos", "line",
        _state(F.col("start"), F.col("last_before"), F.col("swapped") - F.col("swaps")).alias("inside"),
        _state(F.col("start"), F.col("last_after"), F.col("swapped")).alias("open"),
    ).where("open >= 0")
    ordered = Window.partitionBy("file", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = placed.withColumn("record", F.count_if(F.col("inside") == 0).over(ordered))
    # Record 0 of a block is the end of one that began earlier; it is sent to the block it began in.
    heads = (
        numbered.where("record = 0").groupBy("file", "block")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("lines"), F.min("open").alias("open"))
        .select("file", "block", F.array_join("lines.line", "").alias("text"))
    )
    owners = numbered.groupBy("file", "block").agg(F.max("record").alias("records")).withColumn(
        "owner", F.last(F.when(F.col("records") > 0, F.col("block")), ignorenulls=True).over(earlier))
    tails = (
        heads.join(owners.select("file", "block", "owner"), ["file", "block"]).groupBy("file", F.col("owner").alias("block"))
        .agg(F.sort_array(F.collect_list(F.struct(F.col("block").alias("at"), "text"))).alias("tails"))
        .select("file", "block", F.array_join("tails.text", "").alias("tail"))
    )
    several = (F.col("inside") == 1) | (F.col("open") == 1)
    whole = Window.partitionBy("file", "block", "record")
    gathered = (
        numbered.withColumn("lines", F.collect_list(F.when(several, F.struct("pos", "line"))).over(whole))
        .withColumn("unclosed", F.max(F.struct("pos", "open")).over(whole)["open"] == 1)
        .where((F.col("inside") == 0) & (F.col("record") > 0)).join(tails, ["file", "block"], "left")
    )
    text = F.when(F.size("lines") == 0, F.col("line")).otherwise(F.array_join(F.sort_array("lines")["line"], ""))
    text = F.when(F.col("unclosed") & F.col("tail").isNotNull(), F.concat(text, "tail")).otherwise(text)
    short = _without_end(text)
    too_long = F.raise_error(F.concat(F.lit("a quoted cell is not closed: "), "file")).cast("string")
    longest = F.array_max(F.transform(F.regexp_extract_all(short, F.lit(QUOTED), 0), F.length))
    return gathered.select(
        "file", "block", "pos",
        F.when((F.size("lines") > 0) & (F.length(short) > MOST_CHARS) & (longest > MOST_CHARS), too_long).otherwise(short).alias("line"))


def classify(lines: DataFrame) -> DataFrame:
    """Add the ``kind`` of each line, tested in this order, and the stripped ``cells`` of those that aren't data at a glance."""
    # Most lines hold none of the telling words and are data at a glance.
    telling = F.lower("line").rlike("|".join((*METADATA_LABELS, *KNOWN_COLUMNS)))
    filled = F.col("line").rlike(f'[^,"{WHITESPACE}]')
    told = lines.withColumn("plain_data", F.coalesce(filled & ~telling, F.lit(False)))
    with_cells = told.withColumn("cells", F.when(~F.col("plain_data"), cells(F.col("line"))))
    lowered = F.transform("cells", F.lower)
    labels = F.array(*(F.lit(label) for label in METADATA_LABELS))
    known = F.array(*(F.lit(name) for name in KNOWN_COLUMNS))
    return with_cells.withColumn(
        "kind",
        F.when(F.col("plain_data"), DATA)
        .when(F.forall("cells", lambda c: c == ""), BLANK)
        .when(F.arrays_overlap(lowered, labels), META)
        .when(F.size(F.array_intersect(lowered, known)) >= 2, HEADER)
        .otherwise(DATA),
    ).drop("plain_data")


def _column_layout() -> Column:
    """Position of each known column in a header; of a repeated name the last."""
    backwards = F.reverse(F.transform("cells", F.lower))

    def position(name: str) -> Column:
        found = F.array_position(backwards, name)
        return F.when(found > 0, F.size("cells") - found).cast("int").alias(name)

    return F.struct(*(position(name) for name in KNOWN_COLUMNS))


def _scan_blocks(classified: DataFrame) -> DataFrame:
    """Running state of each line within its block.

    ``seen`` counts data lines so far; ``at_header`` and ``at_blank`` are that count
    at the last header and at the last blank line. A data line is in a table exactly
    if no blank line came after a data line of the section, i.e. ``at_blank <= at_header``.
    Metadata lines count as nothing; filtering them here would push the parsing of
    every line into the filter and do it twice.
    """
    so_far = (
        Window.partitionBy("file", "block").orderBy("pos")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    kind = F.col("kind")
    layout = F.when(kind == HEADER, _column_layout())
    return (
        classified
        .withColumn("seen", F.count_if(kind == DATA).over(so_far))
        .withColumns({
            "at_header": F.max(F.when(kind == HEADER, F.col("seen"))).over(so_far),
            "at_blank": F.max(F.when(kind == BLANK, F.col("seen"))).over(so_far),
            "layout": F.last(layout, ignorenulls=True).over(so_far),
        })
        .withColumn(
            "tables",
            F.count_if((kind == DATA) & (F.col("seen") == F.col("at_header") + 1)).over(so_far),
        )
    )


def _carry(scanned: DataFrame) -> DataFrame:
    """State at the start of each block: one row per block, scanned in file order.

    It reads the same columns as the main branch, so Spark reuses the shuffle of the
    lines instead of reading the files again.
    """
    summary = scanned.groupBy("file", "block").agg(
        F.max("seen").alias("data"),
        F.max("at_header").alias("at_header"),
        F.max("at_blank").alias("at_blank"),
        F.max_by("layout", "pos").alias("layout"),
        F.max("tables").alias("tables"),
        F.bool_or((F.col("kind") == DATA) & F.col("at_header").isNull()).alias("starts_inside"),
    )
    earlier = (
        Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        summary
        .withColumn("in_seen", F.coalesce(F.sum("data").over(earlier), F.lit(0)))
        .withColumns({
            "in_header": F.max(F.col("in_seen") + F.col("at_header")).over(earlier),
            "in_blank": F.max(F.col("in_seen") + F.col("at_blank")).over(earlier),
            "in_layout": F.last("layout", ignorenulls=True).over(earlier),
        })
        # The first data line of this block may open the table of a header in an earlier one.
        .withColumn(
            "opens",
            F.coalesce(F.col("starts_inside") & (F.col("in_header") == F.col("in_seen")), F.lit(False))
            .cast("int"),
        )
        .withColumn(
            "in_tables", F.coalesce(F.sum(F.col("tables") + F.col("opens")).over(earlier), F.lit(0))
        )
        .select("file", "block", "in_seen", "in_header", "in_blank", "in_layout", "opens", "in_tables")
    )


def data_rows(lines: DataFrame) -> DataFrame:
    """Data lines of all tables, aligned by the header of their own table."""
    scanned = _scan_blocks(classify(placed_only(lines)))
    # A large carry is merged, which costs the lines nothing: they are partitioned and
    # sorted by block already. A small one is broadcast once its size is known.
    placed = scanned.join(_carry(scanned), ["file", "block"])
    header = F.coalesce(F.col("in_seen") + F.col("at_header"), F.col("in_header"))
    blank = F.coalesce(F.col("in_seen") + F.col("at_blank"), F.col("in_blank"), F.lit(0))
    # Cells of data are told apart here: the branch of the carry has no use for them.
    kept = placed.where((F.col("kind") == DATA) & (blank <= header)).withColumns(
        {"layout": F.coalesce("layout", "in_layout"), "cells": cells(F.col("line"))}
    )

    def cell(name: str) -> Column:
        return F.nullif(F.get("cells", F.col(f"layout.{name}")), F.lit("")).alias(name)

    return kept.select(
        *(cell(name) for name in KNOWN_COLUMNS),
        (F.col("in_tables") + F.col("opens") + F.col("tables") - 1).cast("int").alias("table_index"),
        file_name(F.col("file")).alias("source_file"),
    )


def metadata_rows(lines: DataFrame) -> DataFrame:
    """First two filled cells of each metadata line; lines with fewer are dropped."""
    filled = F.filter("cells", lambda c: c != "")
    # A line with a label among its cells holds the label's text; only those are parsed.
    candidates = lines.where(F.lower("line").rlike("|".join(METADATA_LABELS)))
    return (
        classify(candidates).where(F.col("kind") == META)
        .select(filled.alias("filled"), "file").where(F.size("filled") >= 2)
        .select(
            F.get("filled", F.lit(0)).alias("field_name"),
            F.get("filled", F.lit(1)).alias("field_value"),
            file_name(F.col("file")).alias("source_file"),
        )
    )


def read_tables(spark: SparkSession, source: Source) -> DataFrame:
    return data_rows(csv_lines(spark, source))


def read_metadata(spark: SparkSession, source: Source) -> DataFrame:
    return metadata_rows(csv_lines(spark, source))
