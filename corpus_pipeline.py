"""The corpus pipeline: toxic documents go, one document of each group of near copies stays, documents with benchmark
items go, the sources are mixed to their weights, and every row gets a shard and a slot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewmill.llm import decontaminate, mixing, near_dedup, sharding, toxicity
from reviewmill.session import materialise

SHARDS = sharding.Tree.even(2, 2, 2)


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.place(docs, SHARDS, ("text", "lang", "source", "n_chars"))


STAGES = [
    ("toxicity", toxicity_filter),
    ("near_dedup", near_deduplication),
    ("decontamination", decontamination),
    ("mixing", source_mix),
    ("sharding", shards),
]

# Trained scores and latent search have no SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
