"""Error types of wrong predictions and a bounded list of cases per model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewmill import settings
from reviewmill.functions.text import SPACE

CASE_COLUMNS = [
    "task", "model", "course_id", "clean_text", "true_label", "predicted_label", "error_type", "analysis_note",
]


def error_type(truth: Column, guess: Column, text: Column) -> Column:
    """First rule that fits; contrast words count inside longer words too."""
    lower = F.lower(text)
    contrast = F.lit(False)
    for word in settings.CONTRAST_WORDS:
        contrast = contrast | F.contains(lower, F.lit(word))
    words = F.regexp_count(text, F.lit(rf"(?U)[^{SPACE}]+"))
    return (
        F.when((truth == "positive") & (guess == "negative"), "positive_predicted_as_negative")
        .when((truth == "negative") & (guess == "positive"), "negative_predicted_as_positive")
        .when((truth == "neutral") | (guess == "neutral"), "neutral_confusion")
        .when(words <= settings.SHORT_REVIEW_WORDS, "short_review")
        .when(contrast, "mixed_sentiment")
        .otherwise("other_sentiment_error")
    )


def wrong(predictions: DataFrame, truth: str = "true_label", guess: str = "predicted_label") -> DataFrame:
    return predictions.filter(F.col(truth) != F.col(guess))


def sentiment_errors(predictions: DataFrame) -> DataFrame:
    text = F.coalesce("clean_text", F.lit(""))
    return wrong(predictions).withColumn("error_type", error_type(F.col("true_label"), F.col("predicted_label"), text))


def error_type_counts(predictions: DataFrame) -> DataFrame:
    return sentiment_errors(predictions).groupBy("model", "error_type").agg(F.count("*").alias("cases"))


def label_set_errors(predictions: DataFrame) -> DataFrame:
    """Reviews whose joined set of flags differs from the truth."""
    return wrong(predictions, "true_labels", "predicted_labels")


def first_cases(errors: DataFrame, limit: int, id_column: str = "review_id") -> DataFrame:
    """The first ``limit`` errors of every model.  Ids alone are ranked, ``limit`` per model and task before the
    shuffle; the texts of the winners are fetched afterwards."""
    by_id = Window.partitionBy("model").orderBy(id_column)
    ids = errors.select("model", id_column).withColumn("_rank", F.row_number().over(by_id)).filter(F.col("_rank") <= limit)
    ids = ids.select("model", F.col(id_column).alias("_id")).distinct()
    found = errors.withColumnRenamed("model", "_model").join(
        ids, (F.col("_model") == F.col("model")) & F.col(id_column).eqNullSafe(F.col("_id"))
    ).drop("_model", "_id")
    # Repeated ids bring more rows than places.
    return found.withColumn("_rank", F.row_number().over(by_id)).filter(F.col("_rank") <= limit).drop("_rank")


def error_cases(
    sentiment: DataFrame | None,
    multilabel: DataFrame | None,
    limit: int = settings.MAX_ERROR_CASES,
    id_column: str = "review_id",
) -> DataFrame:
    """The case list of both tasks, or one ``not_run`` row if there is no error to show."""
    parts = []
    if sentiment is not None:
        parts.append(
            first_cases(sentiment_errors(sentiment), limit, id_column)
            .withColumn("task", F.lit("sentiment"))
            .withColumn("analysis_note", F.lit(settings.SENTIMENT_ERROR_NOTE))
        )
    if multilabel is not None:
        mismatches = label_set_errors(multilabel).withColumn("model", F.lit(settings.OVR_NAME))
        parts.append(
            first_cases(mismatches, limit, id_column)
            .withColumnsRenamed({"true_labels": "true_label", "predicted_labels": "predicted_label"})
            .withColumn("task", F.lit("multi_label_feedback_type"))
            .withColumn("error_type", F.lit("label_set_mismatch"))
            .withColumn("analysis_note", F.lit(settings.LABEL_SET_ERROR_NOTE))
        )
    cases = None
    for part in parts:
        if "course_id" not in part.columns:
            part = part.withColumn("course_id", F.lit(None).cast("string"))
        part = part.select(*CASE_COLUMNS)
        cases = part if cases is None else cases.unionByName(part)
    if cases is not None and not cases.isEmpty():
        return cases
    empty = ("not_available", "", None, "", "", "", "not_run", "No predictions were available for error analysis.")
    return SparkSession.active().createDataFrame([empty], ", ".join(f"{c} string" for c in CASE_COLUMNS))
