"""Multi-label feedback types: one binary classifier per flag on shared features, fitted together."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill import settings
from reviewmill.operators import linear
from reviewmill.operators.features import MULTILABEL, TextFeatures, Vectorizer, multilabel_variant_features
from reviewmill.operators.guards import CONSTANT_FLAGS, NO_FLAGS, multilabel_not_run
from reviewmill.operators.metrics import multilabel_metrics, per_label_report
from reviewmill.operators.labeling import feature_columns
from reviewmill.session import materialise


@dataclass(frozen=True)
class MultilabelResult:
    results: DataFrame
    predictions: DataFrame | None
    label_report: DataFrame | None
    #: What was fitted, and the fit; None if every flag keeps a constant.
    problem: linear.Problem | None = None
    model: linear.Linear | None = None


def flag_shares(train: DataFrame, flags: Sequence[str]) -> DataFrame:
    """One row: ``rows`` and the number of positives per flag."""
    return train.agg(
        F.count("*").alias("rows"), *[F.coalesce(F.sum(F.col(f"`{f}`")), F.lit(0)).alias(f) for f in flags]
    )


def majority(train: DataFrame, flags: Sequence[str]) -> dict[str, int]:
    """The constant prediction per flag: 1 where at least half of the training rows have it."""
    row = flag_shares(train, flags).first()
    return {f: int(row["rows"] > 0 and row[f] / row["rows"] >= 0.5) for f in flags}


def predict_majority(train: DataFrame, test: DataFrame, flags: Sequence[str]) -> DataFrame:
    constants = majority(train, flags)
    for flag in flags:
        test = test.withColumn(f"pred_{flag}", F.lit(constants[flag]))
    return test


def label_set(flags: Sequence[str], prefix: str = "") -> Column:
    """Names of the flags that are set, joined by ``"; "`` in the given order."""
    return F.concat_ws("; ", *[F.when(F.col(f"`{prefix}{f}`") == 1, F.lit(f)) for f in flags])


def flag_problem(train: DataFrame, vectorizer: Vectorizer, flags: Sequence[str], totals, rows: int) -> linear.Problem:
    """One balanced logistic loss per flag, all on the same packed rows, which are stored as the passes read them;
    penalty half the squared norm without the intercepts."""
    sides, weights = [], []
    for i, flag in enumerate(flags):
        has = F.col(f"`{flag}`") == 1
        sides.append(F.when(has, 1.0).otherwise(-1.0).alias(f"side_{i}"))
        weights.append(F.when(has, rows / (2.0 * totals[flag])).otherwise(rows / (2.0 * (rows - totals[flag]))).alias(f"weight_{i}"))
    vectors = vectorizer.rows(train, flags)
    table = materialise(vectors.select(*linear.entry_columns(vectors), *sides, *weights))
    each = range(len(flags))
    sides, weights = tuple(f"side_{i}" for i in each), tuple(f"weight_{i}" for i in each)
    return linear.Problem(table, sides, weights, len(vectorizer.terms), free_intercept=True, scale=np.array(vectorizer.idf))


def train_multilabel(
    train: DataFrame,
    test: DataFrame,
    flags: Sequence[str] = tuple(settings.FEEDBACK_FLAGS),
    features: TextFeatures = MULTILABEL,
    id_column: str = "review_id",
) -> MultilabelResult:
    """Flags that never vary in training keep their constant; the others get a balanced logistic
    regression each, all fitted in the same passes over the stored vectors."""
    spark = train.sparkSession
    available = [f for f in flags if f in train.columns]
    if not available:
        return MultilabelResult(multilabel_not_run(spark, NO_FLAGS), None, None)
    for flag in available:
        train = train.withColumn(flag, F.coalesce(F.col(f"`{flag}`"), F.lit(0)).cast("int"))
        test = test.withColumn(f"true_{flag}", F.coalesce(F.col(f"`{flag}`"), F.lit(0)).cast("int"))
    totals = flag_shares(train, available).first()
    rows = totals["rows"]
    active = [f for f in available if 0 < totals[f] < rows]
    name = settings.OVR_NAME if active else settings.MAJORITY_NAME
    problem = model = None
    test = test.select(id_column, "clean_text", *[f"`true_{f}`" for f in available])
    if active:
        vectorizer = Vectorizer.fit(train.select(*feature_columns(train)), features)
        problem = flag_problem(train, vectorizer, active, totals, rows)
        model = linear.fit_logistic(problem)
        if not model.converged:
            warnings.warn(f"stopped after {model.passes} passes without converging", stacklevel=2)
        scored = linear.scored(vectorizer.rows(test, test.columns), model)
        found = [(F.get("margins", i) > 0).cast("int").alias(f"pred_{flag}") for i, flag in enumerate(active)]
        test = scored.select("*", *found).drop("margins")
    constants = {f: int(totals[f] / rows >= 0.5) if rows else 0 for f in available if f not in active}
    for flag, value in constants.items():
        test = test.withColumn(f"pred_{flag}", F.lit(value))
    wide = materialise(test.withColumn("model", F.lit(name)))
    results = multilabel_metrics(wide, available)
    if not active:
        results = results.withColumn("notes", F.lit(CONSTANT_FLAGS))
    predictions = wide.select(
        id_column,
        "clean_text",
        label_set(available, "true_").alias("true_labels"),
        label_set(available, "pred_").alias("predicted_labels"),
        *[f"`{side}_{f}`" for f in available for side in ("true", "pred")],
    )
    return MultilabelResult(results, predictions, per_label_report(wide, available), problem, model)


def train_multilabel_variant(
    split: DataFrame, mode: str = "quick", flags: Sequence[str] = tuple(settings.FEEDBACK_FLAGS)
) -> MultilabelResult:
    """Second setting: train and validation rows together, accents stripped, no upper frequency
    limit, and only flags that vary in the train split."""
    train = split.filter("split = 'train'")
    present = [f for f in flags if f in split.columns]
    if present:
        varies = train.agg(*[F.count_distinct(F.col(f"`{f}`")).alias(f) for f in present]).first()
        present = [f for f in present if varies[f] > 1]
    if not present:
        reason = "No multi-label feedback columns with positive and negative examples were available."
        return MultilabelResult(multilabel_not_run(split.sparkSession, reason), None, None)
    test = split.filter("split = 'test'")
    if test.isEmpty():
        return MultilabelResult(multilabel_not_run(split.sparkSession, "Test split is empty."), None, None)
    merged = split.filter("split in ('train', 'val')")
    rows = merged.count()
    result = train_multilabel(merged, test, present, multilabel_variant_features(rows, mode))
    labelled = (
        result.results.withColumn("task", F.lit("feedback_type_multilabel"))
        .withColumn("labels_used", F.lit(",".join(present)))
        .withColumn("train_rows", F.lit(rows))
        .withColumn("test_rows", F.lit(test.count()))
    )
    return replace(result, results=labelled)
