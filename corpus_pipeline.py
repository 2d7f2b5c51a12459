"""A training corpus from `documents`: five stages, each written as Parquet before the next reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemart.llm import decontamination, language, mixing, neardup, sharding
from tidemart.llm.common import read, written


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents too far from every language learned from `docs` go, and those without a letter."""
    return language.accepted(docs, language.fit(docs))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8) the document with the smallest id stays."""
    return neardup.first_of_groups(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontamination.decontaminated(docs, read(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or up to three times."""
    return mixing.mixture(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each row of the mix lies: its shard and its slot there."""
    return sharding.balanced_shards(docs)


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

# SQL can express neither the classifier nor the edit distances nor the budget fitting.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
