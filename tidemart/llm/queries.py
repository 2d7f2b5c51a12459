"""The registered queries over the corpus tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import (
    blocks, decontamination, language, likelihood, mixing, neardup, phrases, pii, quality, search, sharding, suffixes, urls)
from tidemart.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(read(spark, sf_dir, "documents")).drop("spans", "text")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages carry the ids of the documents made from them, so the documents' quality labels serve."""
    labels = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return urls.judged(read(spark, sf_dir, "pages"), labels).withColumn("purity", F.round("purity", 6))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.balanced_shards(read(spark, sf_dir, "documents"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(read(spark, sf_dir, "documents")).drop("print")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.benchmark_matches(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return likelihood.likelihoods(read(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"), words=2)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return language.predict(docs, language.fit(docs))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocks.exact_duplicates(read(spark, sf_dir, "documents"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def registry() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}


def statements() -> dict[str, str]:
    return {
        "op2_url_filters": urls.oracle(),
        "op10_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
                   doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept,
                   sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
        "op12_collocations": phrases.oracle(),
        "op13_ranked_search": search.oracle(),
    }
