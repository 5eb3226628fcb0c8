"""The operators applied to whole tables, and the SQL their results must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewmill.llm import (
    decontaminate,
    exact_dedup,
    hard_negatives,
    license_scan,
    lm_scoring,
    mixing,
    near_dedup,
    quality_rules,
    secret_scan,
    sharding,
    token_alignment,
    token_counts,
    toxicity,
)
from reviewmill.llm.oracles import ORACLES
from reviewmill.llm.shared import documents

SHARDS = sharding.Tree.even(2, 2, 2)
# Vocabulary files, at paths that every executor can read.
ALIGNED = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.pseudo_likelihood(documents(spark, sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxic_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(documents(spark, sf_dir))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.copies(documents(spark, sf_dir))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(documents(spark, sf_dir), SHARDS)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count(documents(spark, sf_dir))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(documents(spark, sf_dir), *ALIGNED)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {f.__name__: f for f in (op1_license_scan, op2_lm_scoring, op3_toxicity, op4_secret_scan, op5_decontamination, op6_quality_rules, op7_near_dedup, op8_mixing, op9_sharding, op10_token_counts, op11_token_alignment, op12_exact_dedup, op13_hard_negatives)}
__all__ = ["ORACLES", "QUERIES"]
