"""Exact dedup: streaming deduplication over disk-backed keyed state without expiry.

Arrivals carry the digest of their bytes, their stable identifier and a content locator (file
and row number). The stream keeps per digest the row that stays (largest id; ties by locator)
and the number of arrivals, in RocksDB state checkpointed to the shared folder. Nothing
expires, so a copy that comes in a later batch still meets its first one. Arrivals of a batch
are summed within each task before the shuffle: a text that makes up a third of all rows
sends one row per task.

On a hit (a digest that arrives again) full bytes are compared: of each digest the smallest
and the largest text are found, within tasks first, so that each task sends a text once;
only if both are the same bytes are all texts between them. A digest that turns out to
stand for several texts is split into one group each.

Defined results: null text is empty text and equal to it. A null doc_id is smaller than any
other. Of repeated rows with the same doc_id and text, only the one with the last locator is
kept. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import FILE, ROW, file_backed, located, saved, shared_dir

_STORE = "spark.sql.streaming.stateStore"
#: Disk-backed state; without preallocated files, which many small stores would fill a disk with.
SETTINGS = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.allowFAllocate": "false",
}
_STATE = f"digest string, stays struct<doc_id:long,{FILE}:string,{ROW}:long>, group_size long"
_STAYS = f"max(struct(doc_id, {FILE}, {ROW}))"


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def arrivals(docs: DataFrame, digest=sha256) -> tuple[DataFrame, str]:
    """digest, doc_id and locator of every row, written once: what the stream reads, and its folder."""
    path = shared_dir(docs.sparkSession, "arrivals")
    came = _texts(docs, digest).select("digest", "doc_id", FILE, ROW)
    came.write.parquet(path)
    return docs.sparkSession.read.schema(came.schema).parquet(path), path


def keep_state(stream: DataFrame, checkpoint: str, out: str) -> None:
    """Take in all that the stream has now; the state stays in ``checkpoint`` for later arrivals.

    Each batch writes the groups it changed to its own folder in ``out``; a batch that runs
    again replaces it.
    """
    spark = stream.sparkSession
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    try:
        groups = stream.groupBy("digest").agg(F.expr(_STAYS).alias("stays"), F.count("*").alias("group_size"))
        query = (
            groups.writeStream.outputMode("update").trigger(availableNow=True).option("checkpointLocation", checkpoint)
            .foreachBatch(lambda df, batch: df.write.mode("overwrite").parquet(f"{out}/batch={batch}"))
            .start()
        )
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def groups(spark, out: str) -> DataFrame:
    """The last state of every digest."""
    changed = spark.read.schema(f"{_STATE}, batch long")
    last = changed.parquet(out).groupBy("digest").agg(F.max(F.struct("batch", "stays", "group_size")).alias("g"))
    return last.select("digest", "g.stays", "g.group_size")


def _texts(docs: DataFrame, digest) -> DataFrame:
    rows = located(docs.select("doc_id", "text")).withColumn("text", F.coalesce("text", F.lit("")))
    return rows.withColumn("digest", digest(F.col("text")))


def collided(docs: DataFrame, digest=sha256) -> DataFrame:
    """Digests of several different texts: full bytes of all texts of a digest are compared."""
    ends = _texts(docs, digest).groupBy("digest").agg(F.min("text").alias("low"), F.max("text").alias("high"))
    return ends.where("low != high").select("digest")


def exact_groups(docs: DataFrame, digest=sha256) -> DataFrame:
    """Per row: doc_id, its locator, keep_id, group_size, kept, digest.

    ``digest`` can be replaced to try colliding digests.
    """
    spark = docs.sparkSession
    docs = file_backed(docs).select(F.col("doc_id").cast("long"), "text")
    came, path = arrivals(docs, digest)
    if came.isEmpty():
        state = spark.createDataFrame([], _STATE)
    else:
        out = shared_dir(spark, "groups")
        keep_state(spark.readStream.schema(came.schema).parquet(path), shared_dir(spark, "state"), out)
        state = groups(spark, out)
    split = saved(collided(docs, digest), "collided")
    checked = came.join(state, "digest").select(
        "doc_id", FILE, ROW, "digest", F.col("stays.doc_id").alias("keep_id"), "group_size",
        ((F.col(f"stays.{FILE}") == F.col(FILE)) & (F.col(f"stays.{ROW}") == F.col(ROW))).alias("kept"))
    if split.isEmpty():
        return checked
    rows = _texts(docs, digest).join(split, "digest")
    texts = rows.groupBy("digest", "text").agg(F.expr(_STAYS).alias("stays"), F.count("*").alias("group_size"))
    several = rows.join(texts, ["digest", "text"])
    return checked.join(split, "digest", "left_anti").unionByName(several.select(
        "doc_id", FILE, ROW, "digest", F.col("stays.doc_id").alias("keep_id"), "group_size",
        ((F.col(f"stays.{FILE}") == F.col(FILE)) & (F.col(f"stays.{ROW}") == F.col(ROW))).alias("kept")))


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns."""
    docs = file_backed(docs)
    kept = exact_groups(docs).where("kept").select(FILE, ROW)
    return located(docs).join(kept, [FILE, ROW], "left_semi").drop(FILE, ROW)
