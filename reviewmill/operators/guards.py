"""Can a model run at all?  Reasons and the rows that report it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill import settings

FEW_CLASSES = "Not enough labeled classes for sentiment classification."
NO_FLAGS = "No multi-label feedback columns found."
CONSTANT_FLAGS = "All labels were constant in training data."
FEW_DOCUMENTS = "Not enough documents for topic modeling."


def run_guard(
    split: DataFrame, keys: Sequence[str] = (), label: str = "sentiment_label", text: str = "clean_text"
) -> DataFrame:
    """Per group: classes in train, rows in test, documents, and the status of the classifiers and of
    topic mining with the reason where they cannot run."""
    usable = F.col(text).isNotNull() & F.col(label).isNotNull()
    counts = split.groupBy(*keys).agg(
        F.count_distinct(F.when(usable & (F.col("split") == "train"), F.col(label))).alias("train_classes"),
        F.count(F.when(usable & (F.col("split") == "test"), F.lit(1))).alias("test_rows"),
        F.count("*").alias("documents"),
    )
    classify = (F.col("train_classes") >= 2) & (F.col("test_rows") > 0)
    mine = F.col("documents") >= settings.MIN_TOPIC_DOCUMENTS
    return counts.select(
        *keys,
        "train_classes",
        "test_rows",
        "documents",
        F.when(classify, "run").otherwise("not_run").alias("sentiment_status"),
        F.when(classify, "").otherwise(FEW_CLASSES).alias("sentiment_notes"),
        F.when(mine, "run").otherwise("not_run").alias("topic_status"),
        F.when(mine, "").otherwise(FEW_DOCUMENTS).alias("topic_notes"),
    )


def sentiment_not_run(spark: SparkSession, reason: str, models: Sequence[str] = tuple(settings.SENTIMENT_MODELS)) -> DataFrame:
    rows = [(model, "not_run", None, None, None, None, None, reason) for model in models]
    return spark.createDataFrame(
        rows,
        "model string, status string, accuracy double, precision_macro double, recall_macro double, "
        "macro_f1 double, weighted_f1 double, notes string",
    )


def multilabel_not_run(spark: SparkSession, reason: str, model: str = settings.OVR_NAME) -> DataFrame:
    return spark.createDataFrame(
        [(model, "not_run", None, None, None, None, reason)],
        "model string, status string, micro_f1 double, macro_f1 double, hamming_loss double, "
        "subset_accuracy double, notes string",
    )
