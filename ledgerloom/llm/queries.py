"""The operators over the test tables: one query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import alignment, bpe, context_tree, decontaminate, divergence, exact_dedup, html_text, licenses, mixing, quality, simhash, token_counts, toxicity
from ledgerloom.llm.common import in_fold, table

#: Target shares of the mix: a third source counts double, a junk source half, the rest 1.
WEIGHTS = {"src0": 2.0, "src3": 2.0, "src6": 2.0, "src9": 2.0, "src17": 0.5}


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"))


def op2_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = in_fold(F.col("doc_id"), context_tree.FOLDS, context_tree.HELD_OUT)
    return context_tree.score_texts(table(spark, sf_dir, "documents")).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    held_out = in_fold(F.col("doc_id"), quality.FOLDS, quality.HELD_OUT)
    return quality.score_quality(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extract_pages(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), WEIGHTS)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    held_out = in_fold(F.col("doc_id"), toxicity.FOLDS, toxicity.HELD_OUT)
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted", F.size("passages").alias("n_passages"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    return found.withColumn("notices", F.array_join("notices", ","))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.encode(table(spark, sf_dir, "documents"), decoded=True)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.align(docs.withColumn("doc_id", F.col("doc_id").cast("long")), ids=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_decontaminate, op2_context_tree, op3_simhash, op4_quality, op5_html_text, op6_mix, op7_token_counts, op8_toxicity,
        op9_licenses, op10_exact_dedup, op11_divergence, op12_bpe, op13_alignment)
}
