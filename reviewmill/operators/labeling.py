"""Sentiment label construction."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.labels import label_3class, label_5class, sentiment_from_rating, three_from_five
from reviewmill.functions.numbers import to_number


@dataclass(frozen=True)
class SentimentInfo:
    available: bool
    source: str
    reason: str


NO_LABELS = SentimentInfo(False, "none", "No explicit sentiment labels or numeric ratings were found.")
FROM_LABEL = SentimentInfo(
    True, "explicit_label", "Explicit sentiment labels were mapped to three classes."
)
FROM_RATING = SentimentInfo(
    True, "rating", "Ratings were mapped to three sentiment classes by fixed thresholds."
)


def add_labels(
    df: DataFrame, source: str = "label_raw", label_source: str | None = None, short_spellings: bool = False
) -> DataFrame:
    """Add ``label_5class`` and ``sentiment_label``; rows whose label is unknown are dropped."""
    if source not in df.columns:
        raise ValueError(f"no label column {source}")
    labelled = (
        df.withColumn("label_5class", label_5class(F.col(source), short_spellings))
        .filter(F.col("label_5class").isNotNull())
        .withColumn("sentiment_label", three_from_five(F.col("label_5class")))
    )
    return labelled if label_source is None else labelled.withColumn("label_source", F.lit(label_source))


def label_by_rating(df: DataFrame, rating: str = "rating") -> DataFrame:
    """Label by thresholds; ratings between the thresholds and unreadable ones are dropped."""
    return (
        df.withColumn(rating, to_number(F.col(rating)))
        .withColumn("sentiment_label", sentiment_from_rating(F.col(rating)))
        .filter(F.col("sentiment_label").isNotNull())
    )


def construct_sentiment_labels(df: DataFrame) -> tuple[DataFrame, SentimentInfo]:
    """Explicit labels if any is readable, otherwise ratings if any is readable, otherwise none.

    One aggregate over the two narrow columns decides; the labelled table stays lazy.
    """
    checks = []
    if "explicit_label" in df.columns:
        checks.append(F.max(label_3class(F.col("explicit_label")).isNotNull()).alias("by_label"))
    if "rating" in df.columns:
        checks.append(F.max(to_number(F.col("rating")).isNotNull()).alias("by_rating"))
    found = df.agg(*checks).first().asDict() if checks else {}
    if found.get("by_label"):
        return add_labels(df, "explicit_label"), FROM_LABEL
    if found.get("by_rating"):
        return label_by_rating(df), FROM_RATING
    return df, NO_LABELS


def feature_columns(df: DataFrame) -> list[str]:
    """Columns a model may look at: the text only, never the rating its label may come from."""
    return ["clean_text"] if "clean_text" in df.columns else ["review_text"]
