"""What several operators share: tables, the shared folder, row locators, text folding."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names that no table is expected to have: where a row lies.
FILE, ROW = "__file", "__row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder that the driver and all executors reach.

    It lies in ``spark.checkpoint.dir``. Only a local session may leave that unset; it gets
    a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """The frame written once to the shared folder and read from there: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def rows_per_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """While jobs run in here, tasks hand at most so many rows at a time to Python: for rows that are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def file_backed(docs: DataFrame) -> DataFrame:
    """The frame itself if its rows come straight from files, else a copy in the shared folder.

    Reads of the same files agree on the locators of rows; take this once, before locating a
    frame several times.
    """
    try:
        docs.select("_metadata.row_index")
        return docs
    except AnalysisException:
        return saved(docs, "rows")


def located(docs: DataFrame) -> DataFrame:
    """Add the locator of each row: its file and its number in that file."""
    return file_backed(docs).select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW))


def fold(text: str) -> str:
    """A-Z in lower case, all else as it is; offsets stay."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def in_fold(doc_id: Column, folds: int, number: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == number


def strings(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """A text column as Python strings, null as empty."""
    return [x or "" for x in column.to_pylist()]


class Sent:
    """A broadcast value and a name for what workers derive from it; derived once per worker, one value at a time."""

    _derived: dict = {}

    def __init__(self, spark: SparkSession, value):
        self.name, self.value = uuid.uuid4().hex, spark.sparkContext.broadcast(value)

    def derive(self, make):
        """make(value), kept in the worker until another broadcast's value takes its place."""
        key = (make.__module__, make.__qualname__)
        held = Sent._derived.get(key)
        if held is None or held[0] != self.name:
            Sent._derived.pop(key, None)
            held = Sent._derived[key] = (self.name, make(self.value.value))
        return held[1]

    @staticmethod
    def release() -> None:
        """Let go of what this worker derived in an earlier pass, for one that needs the memory and no broadcast."""
        Sent._derived.clear()
