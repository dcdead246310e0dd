"""Elements of JSON files of any size and shape, read by many tasks.

The text is read up to each closing brace, which Spark splits anywhere. Whether a
brace closes a record depends on the text before it: is it inside a string, and how
deep. As with sectioned CSV, each block is scanned under both assumptions about its
start (outside or inside a string), shrinks to one summary row, and the summaries of
a file are scanned in order to tell every block how it really starts.

The summaries also tell the file's shape, before anything is gathered:

- ``list``: the first character is a bracket; records are the objects at depth one;
- ``lines``: several values in a row; records are the objects at depth zero;
- ``object``: one object and nothing else, however large: none of its text is gathered;
- ``scalar``: no object at the top level: only a text that is one piece is gathered.

Other values of a list (numbers, texts, null, lists, also lists of objects) stand
between records and come out with the record after them, or in a rest at the end of the
file; so do lines that hold no object. So nothing of a file is lost. A file that ends too
early is an error; of compressed files, whose size says nothing about their text, a last
brace that is missing from lines is not noticed.

What is gathered is one record and what stands before it. The part of it that lies in one
block is put together there, in the shuffle that the block scan made; only the parts at
block borders are shuffled again. Blocks are dealt into many parts, so that no task sorts a large
share of a source, however large it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerloom.sources.ordered_text import dealt, ordered_lines, placed_only

ESCAPE = r"(?s)\\."
STRING = r'(?s)"[^"]*(?:"|$)'

LIST, LINES, OBJECT, SCALAR = "list", "lines", "object", "scalar"

START, NOW = Window.unboundedPreceding, Window.currentRow


def _block(last: int) -> WindowSpec:
    """Pieces of a block from its start to ``last``, relative to the current one."""
    return Window.partitionBy("file", "block").orderBy("pos").rowsBetween(START, last)


def _earlier_blocks() -> WindowSpec:
    return Window.partitionBy("file").orderBy("block").rowsBetween(START, -1)


def _sum(column: Column, window: WindowSpec) -> Column:
    return F.coalesce(F.sum(column).over(window), F.lit(0))


def _optional(df: DataFrame) -> list[str]:
    return [c for c in ("size",) if c in df.columns]


def _measure(pieces: DataFrame) -> DataFrame:
    """Per piece: does it flip the string state, and by how much does it change the depth
    (of objects and lists together) and that of lists alone.

    ``depth_0`` holds if the piece starts outside a string, ``depth_1`` if inside. A
    piece ends at a closing brace, which counts if the piece ends outside.
    """
    plain = F.regexp_replace("line", ESCAPE, "")

    def count(text: Column, mark: str) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))

    bare = pieces.select(
        "file", "block", "pos", "line", *_optional(pieces),
        (count(plain, '"') % 2).alias("flips"),
        F.regexp_replace(plain, STRING, "").alias("bare_0"),
        F.regexp_replace(F.concat(F.lit('"'), plain), STRING, "").alias("bare_1"),
    )
    closes = {"0": 1 - F.col("flips"), "1": F.col("flips")}
    lists = {
        h: count(F.col(f"bare_{h}"), "[") - count(F.col(f"bare_{h}"), "]") for h in closes
    }
    return bare.withColumns({
        **{f"depth_{h}": count(F.col(f"bare_{h}"), "{") - closes[h] + lists[h] for h in closes},
        **{f"lists_{h}": lists[h] for h in closes},
    }).drop("bare_0", "bare_1")


def _scan_blocks(pieces: DataFrame) -> DataFrame:
    """Running depth of each piece within its block, under both assumptions."""
    measured = dealt(_measure(pieces)).withColumn("flipped", _sum(F.col("flips"), _block(-1)) % 2)

    def running(name: str, start: int) -> Column:
        inside = (F.col("flipped") + start) % 2 == 1
        change = F.when(inside, F.col(f"{name}_1")).otherwise(F.col(f"{name}_0"))
        return F.sum(change).over(_block(NOW)).alias(f"{name}_{start}")

    return measured.select(
        "file", "block", "pos", "line", *_optional(measured),
        ((F.col("flipped") + F.col("flips")) % 2).alias("flipped"),
        F.lead("pos").over(Window.partitionBy("file", "block").orderBy("pos")).isNull().alias("last_in_block"),
        *(running(name, start) for name in ("depth", "lists") for start in (0, 1)),
    )


def _carry(scanned: DataFrame, whole: bool) -> DataFrame:
    """State at the start of each block and the shape of its file: one row per block, scanned in file order.

    A record ends where the depth falls to ``top`` (1 in a list, 0 otherwise), the lowest it can
    be at a closing brace; so the ends in a block are its closing braces at its lowest depth,
    if that is ``top``. The block's last piece is looked at for itself: that of the file is not closed by a
    brace, but counts as if it were.
    """
    def lowest(name: str, start: int) -> Column:
        depth = F.when((F.col("flipped") + start) % 2 == 0, F.col(f"depth_{start}"))
        place = F.struct(depth.alias("depth"), ((-1 if name == "latest" else 1) * F.col("pos")).alias("at"))
        own = F.col("last_in_block") if name == "tail" else ~F.col("last_in_block")
        return F.min(F.when(depth.isNotNull() & own, place)).alias(f"{name}_{start}")

    ends = ["flipped", "depth_0", "depth_1", "lists_0", "lists_1"]
    sized = F.first("size") if "size" in scanned.columns else F.lit(None).cast("long")
    summary = scanned.groupBy("file", "block").agg(
        *(F.max_by(name, "pos").alias(name) for name in ends), *(lowest(name, h) for h in (0, 1) for name in ("lowest", "latest", "tail")),
        F.min_by(F.regexp_extract("line", r"^[\s\uFEFF]*(\S?)", 1), "pos").alias("head"),
        F.min("pos").alias("first_pos"), F.max(F.when(F.col("line").rlike(r"\S"), F.col("pos"))).alias("last_text"),
        F.count("*").alias("pieces"), F.sum(F.octet_length("line") + 1).alias("bytes"), sized.alias("size"),
    )
    file, ordered = Window.partitionBy("file"), Window.partitionBy("file").orderBy("block")
    listed = F.first("head").over(ordered) == "[" if whole else F.lit(True)
    entered = summary.withColumns({
        "starts_inside": _sum(F.col("flipped"), _earlier_blocks()) % 2, "listed": listed,
    }).select(
        "file", "block", "starts_inside", "listed", "first_pos", "last_text", "pieces", "bytes", "size",
        F.when(F.col("listed") & F.lit(whole), 1).otherwise(0).alias("top"),
        *(_actual(name).alias(name) for name in ("depth", "lists", "lowest", "latest", "tail")),
    ).withColumn("depth_in", _sum(F.col("depth"), _earlier_blocks()))
    has_end = F.col("depth_in") + F.col("lowest.depth") == F.col("top")
    tail_ends = F.col("depth_in") + F.col("tail.depth") == F.col("top")
    placed = entered.withColumns({
        "first_end": F.when(has_end, F.struct("block", F.col("lowest.at").alias("pos"))).when(
            tail_ends, F.struct("block", F.col("tail.at").alias("pos"))),
        "last_end": F.when(tail_ends, F.struct("block", F.col("tail.at").alias("pos"))).when(
            has_end, F.struct("block", (-F.col("latest.at")).alias("pos"))),
    }).withColumns({
        "after_in": F.last("last_end", ignorenulls=True).over(_earlier_blocks()),
        "one_end": F.min("first_end").over(file) == F.max("last_end").over(file),
        "trailing": F.max(F.when(F.col("last_text").isNotNull(), F.struct("block", F.col("last_text").alias("pos")))).over(file)
        > F.max("last_end").over(file),
        "start": F.min(F.struct("block", F.col("first_pos").alias("pos"))).over(file),
        "all_pieces": F.sum("pieces").over(file),
        # A byte order mark is left out by the reader.
        "unread": F.first("size").over(file) - F.sum("bytes").over(file),
        "depth_left": F.sum("depth").over(file), "lists_left": F.sum("lists").over(file),
    })
    shape = (
        F.when(F.col("listed"), LIST).when(F.col("one_end").isNull(), SCALAR)
        .when(F.col("one_end") & ~F.col("trailing"), OBJECT).otherwise(LINES)
    )
    # The last piece counts as closed by a brace; whether it was can only be told by the size.
    unclosed = F.when(F.col("unread").isin(-1, 2), F.col("depth_left") != -1).when(
        F.col("unread").isNotNull(), F.col("depth_left") != 0).otherwise(~F.col("depth_left").isin(-1, 0))
    broken = F.when(F.col("listed") | F.lit(not whole), F.col("lists_left") != 0).otherwise(unclosed)
    return placed.select(
        "file", "block", "starts_inside", "depth_in", "after_in", "top", "start", "all_pieces", shape.alias("shape"), broken.alias("broken"))


def _actual(name: str) -> Column:
    """The value under the assumption that holds for the block."""
    return F.when(F.col("starts_inside") == 1, F.col(f"{name}_1")).otherwise(F.col(f"{name}_0"))


def split_elements(pieces: DataFrame, top: int = 1) -> DataFrame:
    """Runs of elements: ``file, shape, text, first, last``. Needs ``file, block, pos, line``, cut at closing braces.

    A run is a top-level object with the other elements before it; the last run of a file is
    what follows its last object. It still has the separator before it, and a list's
    brackets at both ends of the file. Of an ``object`` file, and of a ``scalar`` one of more than one
    piece, one row without text comes out. ``top`` is 1 for whole files, 0 for pieces from
    within a list. With the file's ``size`` an end that is missing is noticed in lines, too.

    A run is named by the end of the one before it, found in its own block or carried over
    from an earlier one.
    """
    scanned = _scan_blocks(placed_only(pieces))
    placed = scanned.join(_carry(scanned, top == 1), ["file", "block"])
    outside = (F.col("starts_inside") + F.col("flipped")) % 2 == 0
    closed = (F.col("depth_in") + _actual("depth") == F.col("top")) & outside
    here = F.struct("block", "pos")
    whole = ~F.col("shape").isin(OBJECT, SCALAR) | (here == F.col("start"))
    ended = placed.select(
        "file", "block", "pos", "after_in", "shape", "all_pieces", whole.alias("gathered"),
        F.when(F.col("shape").isin(LIST, LINES) | (F.col("all_pieces") == 1), F.col("line")).alias("line"),
        F.when(F.col("broken"), F.raise_error(F.concat(F.lit("JSON ends too early: "), "file")).cast("boolean"))
        .otherwise(closed).alias("ends"),
    )
    last_end = F.last(F.when(F.col("ends"), F.struct("block", "pos")), ignorenulls=True)
    # What of a run lies in one block: no shuffle, the blocks lie together already.
    parts = (
        ended.withColumn("after", F.coalesce(last_end.over(_block(-1)), F.col("after_in"))).where("gathered")
        .groupBy("file", "block", "after", "shape").agg(
            F.sort_array(F.collect_list(F.struct("pos", "line"))).alias("parts"), F.bool_or("ends").alias("complete"))
        .select("file", "block", "after", "shape", "complete", F.array_join("parts.line", "}").alias("text"))
    )
    alone = F.col("after.block").eqNullSafe(F.col("block")) & F.col("complete")
    over_borders = parts.where(~alone).groupBy("file", "after", "shape").agg(
        F.sort_array(F.collect_list(F.struct("block", "text"))).alias("parts"), F.bool_or("complete").alias("complete"),
    ).select("file", "after", "shape", "complete", F.array_join("parts.text", "}").alias("text"))
    runs = parts.where(alone).select("file", "after", "shape", "complete", "text").unionByName(over_borders)
    return runs.select(
        "file", "shape",
        F.when(F.col("shape").isin(LIST, LINES) & F.col("complete"), F.concat("text", F.lit("}"))).otherwise(F.nullif("text", F.lit(""))).alias("text"),
        F.col("after").isNull().alias("first"), (~F.col("complete")).alias("last"),
    )


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    return split_elements(ordered_lines(spark, path, line_sep="}"))
