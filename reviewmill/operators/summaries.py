"""Summary tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill import settings
from reviewmill.operators.labeling import SentimentInfo


def rows_by_source(df: DataFrame, *more: Column) -> DataFrame:
    """dataset_id, rows and further aggregates, in one pass."""
    return df.groupBy(F.col("source_dataset").alias("dataset_id")).agg(F.count("*").alias("rows"), *more)


def data_summary(records: DataFrame, raw: DataFrame, cleaned: DataFrame, info: DataFrame, mode: str) -> DataFrame:
    """Per source record: rows read and rows kept, licence and label source.  Sources without rows
    stay.  ``raw`` and ``cleaned`` come from ``rows_by_source``; ``info`` has (dataset_id, sentiment_source,
    sentiment_available)."""
    raw_rows = raw.select("dataset_id", F.col("rows").alias("raw_rows"))
    kept_rows = cleaned.select("dataset_id", F.col("rows").alias("kept_rows"))
    return (
        records.join(raw_rows, "dataset_id", "left")
        .join(kept_rows, "dataset_id", "left")
        .join(info, "dataset_id", "left")
        .select(
            F.lit(mode).alias("mode"),
            "dataset_id",
            F.coalesce("source_platform", F.lit("")).alias("source_platform"),
            F.coalesce("license", F.lit("")).alias("license"),
            F.coalesce("license_status", F.lit("")).alias("license_status"),
            F.coalesce("raw_rows", F.lit(0)).alias("raw_rows_loaded"),
            F.coalesce("kept_rows", F.lit(0)).alias("cleaned_rows_used"),
            F.coalesce("sentiment_source", F.lit("none")).alias("sentiment_source"),
            F.coalesce("sentiment_available", F.lit(False)).alias("sentiment_available"),
        )
    )


def label_distribution(df: DataFrame, source: str) -> DataFrame:
    """Counts of both label sets from one pass."""
    sets = [(c, t) for c, t in (("sentiment_label", "3class"), ("label_5class", "5class")) if c in df.columns]
    if not sets:
        raise ValueError("no label column; use unlabelled_distribution")
    pairs = F.array(*[F.struct(F.lit(t).alias("label_type"), F.col(c).alias("label")) for c, t in sets])
    return (
        df.select(F.inline(pairs))
        .filter(F.col("label").isNotNull())
        .groupBy("label_type", "label")
        .agg(F.count("*").alias("count"))
        .select("label_type", "label", "count", F.lit(source).alias("source"), F.lit("").alias("notes"))
        .orderBy("label_type", F.col("count").desc(), "label")
    )


def unlabelled_distribution(df: DataFrame, info: SentimentInfo) -> DataFrame:
    return df.agg(F.count("*").alias("count")).select(
        F.lit("sentiment").alias("label_type"),
        F.lit(settings.NO_SENTIMENT).alias("label"),
        "count",
        F.lit("none").alias("source"),
        F.lit(info.reason).alias("notes"),
    )


def flag_distribution(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """(label, positive_count) per feedback flag: one wide aggregate, then turned."""
    present = [flag for flag in flags if flag in df.columns]
    sums = df.agg(*[F.coalesce(F.sum(F.col(f"`{f}`").cast("int")), F.lit(0)).alias(f) for f in present])
    return sums.unpivot([], [f"`{f}`" for f in present], "label", "positive_count")


def course_sentiment(df: DataFrame, rows: int = settings.COURSE_CHART_ROWS) -> DataFrame:
    """The largest (course, sentiment) groups; both keys break ties."""
    return (
        df.filter(F.col("course_id").isNotNull() & F.col("sentiment_label").isNotNull())
        .groupBy("course_id", "sentiment_label")
        .agg(F.count("*").alias("count"))
        .orderBy(F.col("count").desc(), "course_id", "sentiment_label")
        .limit(rows)
    )
