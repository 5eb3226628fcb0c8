"""Classification metrics.

Every metric of every model comes from one aggregate over the predictions; what follows works on
(models x labels x labels) rows at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill import settings


def _ratio(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def _scores(tp: Column, predicted: Column, support: Column) -> list[Column]:
    return [
        _ratio(tp, predicted).alias("precision"),
        _ratio(tp, support).alias("recall"),
        _ratio(2 * tp, predicted + support).alias("f1_score"),
    ]


def confusion_counts(predictions: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    return predictions.groupBy(*keys, "true_label", "predicted_label").agg(F.count("*").alias("rows"))


def label_scores(predictions: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """Precision, recall, F1 and support per label, over labels that occur as truth or prediction."""
    hit = F.when(F.col("true_label") == F.col("predicted_label"), F.col("rows")).otherwise(F.lit(0))
    none = F.lit(0).cast("long")
    sides = F.array(
        F.struct(
            F.col("true_label").alias("label"), hit.alias("tp"), F.col("rows").alias("support"), none.alias("predicted")
        ),
        F.struct(
            F.col("predicted_label").alias("label"), none.alias("tp"), none.alias("support"), F.col("rows").alias("predicted")
        ),
    )
    return (
        confusion_counts(predictions, keys)
        .select(*keys, F.inline(sides))
        .groupBy(*keys, "label")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "support", "predicted")])
        .select(*keys, "label", "tp", *_scores(F.col("tp"), F.col("predicted"), F.col("support")), "support")
    )


def sentiment_metrics(predictions: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """One row per model: accuracy, macro precision, recall and F1, support-weighted F1."""
    return (
        label_scores(predictions, keys)
        .groupBy(*keys)
        .agg(
            (F.sum("tp") / F.sum("support")).alias("accuracy"),
            F.avg("precision").alias("precision_macro"),
            F.avg("recall").alias("recall_macro"),
            F.avg("f1_score").alias("macro_f1"),
            (F.sum(F.col("f1_score") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
        )
        .select(
            *keys,
            F.lit("run").alias("status"),
            "accuracy",
            "precision_macro",
            "recall_macro",
            "macro_f1",
            "weighted_f1",
            F.lit("").alias("notes"),
        )
    )


def _confusion(labels: Sequence[str]) -> tuple[list[Column], Column]:
    """The aggregates of all cells, and the rows that they make."""
    cells = [
        F.sum(((F.col("true_label") == t) & (F.col("predicted_label") == p)).cast("long")).alias(f"_{i}_{j}")
        for i, t in enumerate(labels)
        for j, p in enumerate(labels)
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f"true_{t}").alias("true_label"),
                *[F.coalesce(f"_{i}_{j}", F.lit(0)).alias(f"pred_{p}") for j, p in enumerate(labels)],
            )
            for i, t in enumerate(labels)
        ]
    )
    return cells, rows


def confusion_matrix(
    predictions: DataFrame, labels: Sequence[str] = tuple(settings.THREE_CLASSES), keys: Sequence[str] = ("model",)
) -> DataFrame:
    """One row per true label in the given order, one column per predicted label, zeros included.
    Labels outside the list do not count."""
    cells, rows = _confusion(labels)
    return predictions.groupBy(*keys).agg(*cells).select(*keys, F.inline(rows))


def _share_correct() -> Column:
    return F.avg((F.col("true_label") == F.col("predicted_label")).cast("double")).alias("share_correct")


def best_model(predictions: DataFrame) -> DataFrame:
    """One row: the model with the highest share of correct predictions (ties: first name)."""
    return (
        predictions.groupBy("model")
        .agg(_share_correct())
        .orderBy(F.col("share_correct").desc(), "model")
        .limit(1)
    )


def best_model_confusion(
    predictions: DataFrame, labels: Sequence[str] = tuple(settings.THREE_CLASSES)
) -> DataFrame:
    """The confusion matrix of :func:`best_model`, from the same pass over the predictions."""
    cells, rows = _confusion(labels)
    best = predictions.groupBy("model").agg(*cells, _share_correct()).orderBy(F.col("share_correct").desc(), "model").limit(1)
    return best.select("model", F.inline(rows))


def _flag_totals(df: DataFrame, flags: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One wide row per model; reviews are not multiplied by the number of flags."""
    aggregates = [F.count("*").alias("_rows")]
    same = F.lit(True)
    for i, flag in enumerate(flags):
        truth, guess = F.col(f"`true_{flag}`"), F.col(f"`pred_{flag}`")
        same = same & (truth == guess)
        aggregates += [
            F.sum(((truth == 1) & (guess == 1)).cast("long")).alias(f"_tp{i}"),
            F.sum((guess == 1).cast("long")).alias(f"_pred{i}"),
            F.sum((truth == 1).cast("long")).alias(f"_true{i}"),
        ]
    aggregates.append(F.sum(same.cast("long")).alias("_same"))
    return df.groupBy(*keys).agg(*aggregates)


def _per_flag(totals: DataFrame, flags: Sequence[str], keys: Sequence[str]) -> DataFrame:
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(flag).alias("label"),
                F.col(f"_tp{i}").alias("tp"),
                F.col(f"_pred{i}").alias("predicted"),
                F.col(f"_true{i}").alias("support"),
            )
            for i, flag in enumerate(flags)
        ]
    )
    return totals.select(*keys, "_rows", "_same", F.inline(entries))


def per_label_report(df: DataFrame, flags: Sequence[str], keys: Sequence[str] = ("model",)) -> DataFrame:
    """Precision, recall, F1 and support per flag from ``true_<flag>`` and ``pred_<flag>`` columns."""
    return _per_flag(_flag_totals(df, flags, keys), flags, keys).select(
        *keys, "label", *_scores(F.col("tp"), F.col("predicted"), F.col("support")), "support"
    )


def multilabel_metrics(df: DataFrame, flags: Sequence[str], keys: Sequence[str] = ("model",)) -> DataFrame:
    """One row per model: micro F1, macro F1, Hamming loss, share of reviews with all flags right."""
    tp, predicted, support = F.col("tp"), F.col("predicted"), F.col("support")
    f1 = _scores(tp, predicted, support)[2]
    return (
        _per_flag(_flag_totals(df, flags, keys), flags, keys)
        .groupBy(*keys)
        .agg(
            _ratio(2 * F.sum(tp), F.sum(predicted + support)).alias("micro_f1"),
            F.avg(f1).alias("macro_f1"),
            (F.sum(predicted + support - 2 * tp) / F.sum("_rows")).alias("hamming_loss"),
            (F.max("_same") / F.max("_rows")).alias("subset_accuracy"),
        )
        .select(
            *keys,
            F.lit("run").alias("status"),
            "micro_f1",
            "macro_f1",
            "hamming_loss",
            "subset_accuracy",
            F.lit("").alias("notes"),
        )
    )


def model_comparison(sentiment: DataFrame, multilabel: DataFrame | None = None) -> DataFrame:
    """Long table (model, metric, value) over the models that did run."""
    long = sentiment.filter("status = 'run'").select(
        "model", F.lit("sentiment_macro_f1").alias("metric"), F.col("macro_f1").alias("value")
    )
    if multilabel is None:
        return long
    both = (
        multilabel.filter("status = 'run'")
        .select("model", F.col("macro_f1").alias("multilabel_macro_f1"), F.col("micro_f1").alias("multilabel_micro_f1"))
        .unpivot("model", ["multilabel_macro_f1", "multilabel_micro_f1"], "metric", "value")
    )
    return long.unionByName(both)
