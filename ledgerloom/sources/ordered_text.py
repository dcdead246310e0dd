"""Text lines with their place in the file, read by many tasks per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lines of a block of a compressed file.
LINES = 1 << 19
#: Parts that the blocks of a source are dealt into at least, whatever ``spark.sql.shuffle.partitions`` says: as many as are
#: written without a sort (``spark.shuffle.sort.bypassMergeThreshold``).
PARTS = 200

# File endings of the codecs that Spark's text reader unpacks.
COMPRESSED = r"\.(gz|bz2|lz4|snappy|deflate|zst)$"


def ordered_lines(spark: SparkSession, path: str, line_sep: str | None = None) -> DataFrame:
    """Columns ``file, block, pos, line, size``; size is that of the file in bytes, NULL if it is compressed.

    A block is the part of a file that one task reads, named by its byte offset; its
    size is bounded by ``spark.sql.files.maxPartitionBytes``. ``pos`` grows within a
    block. Together they order the lines of a file without any sort or row number.

    A compressed file is unpacked by one task; its lines are dealt into blocks of ``LINES`` each, so
    that whatever follows is shared by many.
    """
    packed = F.col("_metadata.file_name").rlike(COMPRESSED)
    lines = spark.read.text(path, lineSep=line_sep).select(
        F.col("_metadata.file_path").alias("file"),
        F.when(~packed, F.col("_metadata.file_block_start")).alias("block"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("line"),
        F.when(~packed, F.col("_metadata.file_size")).alias("size"),
    )
    # The number of a row within its task is in the lower 33 bits.
    number = F.col("pos").bitwiseAND(F.lit((1 << 33) - 1))
    return lines.withColumn("block", F.coalesce("block", F.floor(number / LINES)))


def placed_only(lines: DataFrame) -> DataFrame:
    """State what always holds, so that both branches of a block scan infer the same filter.

    Otherwise only the branch next to the join gets it, and Spark no longer sees that
    both could share one shuffle of the lines.
    """
    return lines.where("file IS NOT NULL AND block IS NOT NULL")


def dealt(lines: DataFrame) -> DataFrame:
    """The lines shuffled by block into many parts.

    What scans blocks sorts its part as a whole, so a task needs memory in proportion to it. A number given
    here stays as it is; the session's would be small for large files, and adaptive execution only makes it smaller.
    """
    parts = max(PARTS, int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return lines.repartition(parts, "file", "block")
