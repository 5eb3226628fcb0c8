"""Multinomial naive Bayes over (id, term, weight) rows, in closed form.

The class scores of a review are sums over its terms, so training is one aggregate by
(class, term) and scoring one aggregate by review.  The model is a table with one row per term
and one column per class, at most the vocabulary size, so the planner can broadcast it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.session import materialise


@dataclass(frozen=True)
class NaiveBayes:
    labels: list[str]
    log_prior: list[float]
    log_unseen: list[float]
    terms: DataFrame  # label, term, log_theta for the terms seen with that label


def term_sums(weights: DataFrame, label: str) -> DataFrame:
    """(label, term, weight) summed over reviews; at most classes x vocabulary rows."""
    return weights.groupBy(label, "term").agg(F.sum("weight").alias("weight"))


def class_table(labelled: DataFrame, sums: DataFrame, vocab: DataFrame, label: str, alpha: float) -> DataFrame:
    """One row per class: ``log_prior`` (not smoothed), denominator and ``log_unseen``."""
    known = labelled.filter(F.col(label).isNotNull())
    size = vocab.select(F.count("*").alias("n")).scalar()
    rows = known.select(F.count("*").alias("n")).scalar()
    totals = sums.groupBy(label).agg(F.sum("weight").alias("total"))
    return (
        known.groupBy(label)
        .agg(F.count("*").alias("rows"))
        .join(totals, label, "left")
        .select(
            label,
            F.log(F.col("rows") / rows).alias("log_prior"),
            (F.coalesce("total", F.lit(0.0)) + F.lit(alpha) * size).alias("denominator"),
        )
        .withColumn("log_unseen", F.log(F.lit(alpha) / F.col("denominator")))
    )


def fit(
    labelled: DataFrame, weights: DataFrame, vocab: DataFrame, label: str = "sentiment_label", alpha: float = 1.0
) -> NaiveBayes:
    """``labelled`` has one row per training review, ``weights`` (label, term, weight) rows.

    The sums are stored, because the class totals and the term table both need them and recounting
    would tokenise every review again.
    """
    sums = materialise(term_sums(weights, label))
    rows = class_table(labelled, sums, vocab, label, alpha).orderBy(label).collect()  # one row per class
    denominator = F.create_map(*[F.lit(x) for r in rows for x in (r[label], float(r["denominator"]))])
    log_theta = F.log((F.col("weight") + alpha) / F.element_at(denominator, F.col(label)))
    return NaiveBayes(
        [r[label] for r in rows],
        [r["log_prior"] for r in rows],
        [r["log_unseen"] for r in rows],
        sums.select(F.col(label).alias("label"), "term", log_theta.alias("log_theta")),
    )


def predict(model: NaiveBayes, reviews: DataFrame, weights: DataFrame, id_column: str = "review_id") -> DataFrame:
    """Add ``predicted_label`` and ``score`` to ``reviews``; one without any known term gets its
    prior.  Ties go to the first label in alphabetical order."""
    classes = range(len(model.labels))
    gains = (
        model.terms.groupBy("term")
        .pivot("label", model.labels)
        .agg(F.first("log_theta"))
        .select(
            "term",
            *[
                F.coalesce(F.col(f"`{model.labels[c]}`") - model.log_unseen[c], F.lit(0.0)).alias(f"_gain{c}")
                for c in classes
            ],
        )
    )
    sums = (
        weights.select(id_column, "term", "weight")
        .join(gains, "term", "left")
        .groupBy(id_column)
        .agg(
            F.sum("weight").alias("_sum"),
            *[F.sum(F.col("weight") * F.col(f"_gain{c}")).alias(f"_gain{c}") for c in classes],
        )
    )
    zero = F.lit(0.0)
    scores = F.array(
        *[
            F.lit(model.log_prior[c])
            + F.coalesce("_sum", zero) * model.log_unseen[c]
            + F.coalesce(F.col(f"_gain{c}"), zero)
            for c in classes
        ]
    )
    names = F.array(*[F.lit(name) for name in model.labels])
    scored = reviews.join(sums, id_column, "left").withColumn("_scores", scores)
    best = F.array_max("_scores")
    return scored.select(
        *reviews.columns,
        F.get(names, F.array_position("_scores", best).cast("int") - 1).alias("predicted_label"),
        best.alias("score"),
    )
