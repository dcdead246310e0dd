"""A corpus pipeline over documents: toxicity, exact copies, near copies, contamination, mix.

Each stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes it as Parquet to
the shared folder and reads it again as the next stage's docs. All stages but the last return
the columns of their input. Nulls, empty texts, repeated rows and empty tables are treated as
the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import decontaminate, exact_dedup, mixing, simhash, toxicity
from ledgerloom.llm.common import saved, table
from ledgerloom.llm.queries import WEIGHTS


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the model learns from the labels outside the held-out fold."""
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by fingerprints of three-word shingles within three bits the row with the smallest doc_id stays."""
    return simhash.representatives(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which at least one word in twenty lies in benchmark windows go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as its source's target weight asks for, in shuffled order."""
    return mixing.mix(docs, WEIGHTS)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
]

#: The toxicity model, the fingerprints and their components can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
