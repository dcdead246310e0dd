"""Versioned storage of the company dimension in hash buckets.

Open versions lie in buckets by a hash of the company id: ``current/version=n/bucket=b`` holds
bucket *b* as load *n* left it. A load reads the buckets of its companies and rewrites those
in which a version opens or closes; all others keep their files. Its row in ``commits`` is the
manifest: which load's folder holds each bucket. ``closed/version=n`` holds the versions that load
*n* ended, written once and never rewritten.

A load counts once its commit row is written, so a run that dies half-way leaves the
previous version in force, and its directories are replaced by the next attempt. Earlier
versions can be read until ``expire`` removes the folders that no kept manifest names.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import scd2
from ledgerloom.operators.conform import stack
from ledgerloom.schemas import COMPANY_DIMENSION
from ledgerloom.sinks.warehouse import Warehouse

COMMIT = (
    "batch_id string, committed_at timestamp, max_sk bigint, "
    "new_inserts bigint, updates bigint, unchanged bigint, buckets int, held map<int, int>"
)
#: Buckets of a new dimension, and the most it may have: a manifest names each of them.
BUCKETS, MOST_BUCKETS = 64, 4096


@dataclass(frozen=True)
class Commit:
    """``held``: the version whose folder holds a bucket; buckets without companies are not named."""

    version: int
    max_sk: int
    buckets: int = 0
    held: Mapping[int, int] = field(default_factory=dict)


def bucket_of(company_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(company_id), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class DimensionStore:
    """``buckets`` is taken for a new dimension; one that is stored keeps the number it began with."""

    warehouse: Warehouse
    table: str = "dwh/dim_company"
    buckets: int = BUCKETS

    def __post_init__(self) -> None:
        if not 1 <= self.buckets <= MOST_BUCKETS:
            raise ValueError(f"buckets must be between 1 and {MOST_BUCKETS}")

    def _path(self, part: str, version: int | None = None) -> str:
        parts = [self.table, part] + ([] if version is None else [f"version={version}"])
        return self.warehouse.path(*parts)

    def commits(self) -> DataFrame | None:
        try:
            return (
                self.warehouse.spark.read.format(self.warehouse.format)
                .schema(f"{COMMIT}, version int").load(self._path("commits"))
            )
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _manifests(self, most: int, version: int | None = None) -> list[Commit]:
        """The last commits up to ``version``, newest first."""
        commits = self.commits()
        if commits is None:
            return []
        if version is not None:
            commits = commits.where(F.col("version") <= version)
        rows = commits.select("version", "max_sk", "buckets", "held").orderBy(F.desc("version")).limit(most).collect()
        return [Commit(r.version, r.max_sk, r.buckets, r.held) for r in rows]

    def latest(self) -> Commit:
        """The last commit; a first load that died before its commit row leaves none."""
        return next(iter(self._manifests(1)), Commit(0, 0))

    def current(self, version: int | None = None) -> DataFrame:
        """Open versions, after the last load or after load ``version``."""
        if version is None:
            return self._current(self.latest())
        return self._current(next((c for c in self._manifests(1, version)), Commit(0, 0)))

    def _current(self, commit: Commit, buckets: Iterable[int] | None = None) -> DataFrame:
        spark = self.warehouse.spark
        named = commit.held if buckets is None else {b: commit.held[b] for b in buckets if b in commit.held}
        if not named:
            return spark.createDataFrame([], COMPANY_DIMENSION)
        paths = [f"{self._path('current', version)}/bucket={bucket}" for bucket, version in sorted(named.items())]
        return spark.read.format(self.warehouse.format).schema(COMPANY_DIMENSION).load(paths)

    def read(self) -> DataFrame:
        """All versions of all companies."""
        commit = self.latest()
        if commit.version == 0:
            return self._current(commit)
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in COMPANY_DIMENSION)
        closed = (
            self.warehouse.spark.read.format(self.warehouse.format)
            .schema(f"{columns}, version int").load(self._path("closed"))
            .where(F.col("version") <= commit.version).select(*COMPANY_DIMENSION.names)
        )
        return stack([closed, self._current(commit)])

    def apply(self, incoming: DataFrame, batch_id: str, now: Column, at: datetime) -> dict[str, int]:
        """Load one batch of companies; a batch that changes nothing writes no new version.

        The classified input is written first: everything after it reads that table, so
        the join runs once and a lost executor cannot change what was decided.
        """
        last = self.latest()
        version, buckets = last.version + 1, last.buckets or self.buckets
        bucket = bucket_of(F.col("company_id"), buckets).alias("bucket")
        fresh = self._materialize(incoming, "incoming", version)
        touched = self._numbers(fresh.where("company_id IS NOT NULL").select(bucket))
        open_rows = self._current(last, touched)
        decided = self._materialize(scd2.classify(open_rows, fresh), "decisions", version)
        counts = {k: int(v or 0) for k, v in scd2.stats(decided).first().asDict().items()}
        added = counts["new_inserts"] + counts["updates"]
        if added:
            changed = scd2.changes(decided)
            rewritten = self._numbers(changed.select(bucket))
            self._materialize(scd2.closed_versions(changed, now), "closed", version)
            opened = scd2.opened_versions(changed, now, taken=last.max_sk)
            rows = stack([scd2.untouched(self._current(last, rewritten), changed), opened]).withColumn("bucket", bucket)
            self._materialize(rows.hint("rebalance", F.col("bucket")), "current", version, "bucket")
            held = {**last.held, **{b: version for b in rewritten}}
            commit = (batch_id, at, last.max_sk + added, *counts.values(), buckets, held)
            self._materialize(self.warehouse.spark.createDataFrame([commit], COMMIT).coalesce(1), "commits", version)
        for part in ("incoming", "decisions"):
            self.warehouse.remove(self._path(part, version))
        return counts

    @staticmethod
    def _numbers(buckets: DataFrame) -> list[int]:
        """The buckets that occur, at most ``MOST_BUCKETS``."""
        return sorted(r[0] for r in buckets.distinct().collect())

    def expire(self, keep: int = 1) -> list[str]:
        """Remove the folders of open versions that none of the last ``keep`` commits names; returns them.

        Closed versions are history and stay. Not to be run while a load is writing.
        """
        if keep < 1:
            raise ValueError("the last commit has to be kept")
        kept = self._manifests(keep)
        if not kept:
            return []
        needed = {f"version={v}/bucket={b}" for c in kept for b, v in c.held.items()}
        found = self.warehouse.folders(self._path("current"))
        removed = [f"{v}/{b}" for v in found for b in self.warehouse.folders(f"{self._path('current')}/{v}") if f"{v}/{b}" not in needed]
        for name in removed:
            self.warehouse.remove(f"{self._path('current')}/{name}")
        return sorted(removed)

    def _materialize(self, df: DataFrame, part: str, version: int, *partition_by: str) -> DataFrame:
        target = self._path(part, version)
        df.write.format(self.warehouse.format).partitionBy(*partition_by).mode("overwrite").save(target)
        return self.warehouse.spark.read.format(self.warehouse.format).schema(df.schema).load(target)
