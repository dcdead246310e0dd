"""Path-based warehouse tables, one directory per batch and source.

A batch that is run again replaces its own directories, so a retry after a lost
job never duplicates rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.schemas import RUN_LOG


@dataclass(frozen=True)
class Warehouse:
    """Tables below ``root``, a folder every executor reaches."""

    spark: SparkSession
    root: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def _part(self, table: str, batch_id: str, source: str | None) -> str:
        parts = [table, f"batch_id={batch_id}"] + ([f"source={source}"] if source else [])
        return self.path(*parts)

    def write(
        self, df: DataFrame, table: str, batch_id: str, source: str | None = None,
        skip_empty: bool = False, partition_by: Sequence[str] = (),
    ) -> int:
        """Replace the part of ``table`` that belongs to this batch and source; count its rows.

        The rows are counted while they are written: no second job. With ``skip_empty``
        a part without rows is not kept.
        """
        rows = self.write_counted(df, table, batch_id, source, (), partition_by)["rows"]
        if skip_empty and not rows:
            self.remove(self._part(table, batch_id, source))
        return rows

    def write_counted(
        self, df: DataFrame, table: str, batch_id: str, source: str | None = None,
        counts: Sequence[Column] = (), partition_by: Sequence[str] = (),
    ) -> dict[str, int]:
        """As ``write``; also the named ``counts`` (aggregates), taken in the same job as ``rows``."""
        seen = Observation()
        counted = df.drop("batch_id").observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
        writer = counted.write.format(self.format).options(**self.options).mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).save(self._part(table, batch_id, source))
        return {name: int(value or 0) for name, value in seen.get.items()}

    def drop(self, table: str, batch_id: str, source: str | None = None) -> None:
        """Remove the part of a table that belongs to this batch and source."""
        self.remove(self._part(table, batch_id, source))

    def _at(self, target: str):
        """Hadoop's path and the file system it lies in."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
        return path, path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())

    def remove(self, target: str) -> None:
        """Remove a folder and what is in it."""
        path, files = self._at(target)
        files.delete(path, True)

    def folders(self, target: str) -> list[str]:
        """Names of the folders below a folder; none if it is absent."""
        path, files = self._at(target)
        if not files.exists(path):
            return []
        return sorted(f.getPath().getName() for f in files.listStatus(path) if f.isDirectory())

    def read(
        self, table: str, schema: T.StructType, batch_id: str | None = None,
        source: str | None = None, sources: Sequence[str] | None = None,
        folders: Sequence[tuple[str, str]] | None = None,
    ) -> DataFrame:
        """Rows of a table, or of one batch and source of it; no rows if it was never written.

        ``sources``: of all batches, only the folders of these sources are read; ``folders``: only those of
        these batches and sources, of a table that is partitioned by both. What was
        written with ``usable`` false is read only if the schema asks for that column.
        """
        reader = self.spark.read.format(self.format)
        if batch_id is None:
            columns = T.StructType([f for f in schema if f.name != "batch_id"])
            stored = T.StructType([*columns, T.StructField("batch_id", T.StringType())])
            if folders is not None and "source" not in stored.names:
                stored = T.StructType([*stored, T.StructField("source", T.StringType())])
            load, found = self.path(table), reader.schema(stored)
        else:
            columns = T.StructType([f for f in schema if f.name != "batch_id"])
            load, found = self._part(table, batch_id, source), reader.schema(columns)
        try:
            df = found.load(load)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
        if "usable" in df.columns and "usable" not in schema.names:
            df = df.where(F.coalesce("usable", F.lit(True)))
        if sources is not None and "source" in df.columns:
            df = df.where(F.col("source").isin(list(sources)))
        if folders is not None:
            df = df.where(self._in_folders(folders))
        if batch_id is not None and "batch_id" in schema.names:
            df = df.withColumn("batch_id", F.lit(batch_id))
        return df.select(*schema.names)

    @staticmethod
    def _in_folders(folders: Sequence[tuple[str, str]]) -> Column:
        """A filter on the partition columns alone: other folders aren't opened."""
        batches: dict[str, list[str]] = {}
        for batch, source in folders:
            batches.setdefault(source, []).append(batch)
        wanted = F.lit(False)
        for source, own in sorted(batches.items()):
            wanted = wanted | ((F.col("source") == source) & F.col("batch_id").isin(sorted(own)))
        return wanted

    def truncate(self, table: str, schema: T.StructType) -> None:
        """Empty a table before a full reload."""
        empty = self.spark.createDataFrame([], schema)
        empty.drop("batch_id").write.format(self.format).mode("overwrite").save(self.path(table))

    # Run records: one row per state, the newest of a run counts.

    def log_run(self, record: Mapping[str, object]) -> None:
        row = self.spark.createDataFrame([tuple(record.get(n) for n in RUN_LOG.names)], RUN_LOG)
        target = self.path("run_log", f"run={record['run_id']}", f"state={record['status']}")
        row.coalesce(1).write.format(self.format).mode("overwrite").save(target)

    def runs(self) -> DataFrame:
        try:
            states = self.spark.read.format(self.format).schema(RUN_LOG).load(self.path("run_log"))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], RUN_LOG)
        return latest_state(states.select(*RUN_LOG.names))


def latest_state(states: DataFrame) -> DataFrame:
    newest = F.max_by(F.struct(*RUN_LOG.names), F.struct("created_at", "end_time"))
    return states.groupBy("run_id").agg(newest.alias("state")).select("state.*")


def append_to(df: DataFrame, format: str, **options: str) -> None:
    """Append to any Spark sink, e.g. ``append_to(df, "jdbc", url=..., dbtable=...)``."""
    df.write.format(format).options(**options).mode("append").save()
