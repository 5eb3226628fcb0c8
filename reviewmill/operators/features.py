"""Vocabulary, TF-IDF and class weights.

Two forms of the same features.  The relational form gives (id, term, weight) rows that SQL can
check and naive Bayes can aggregate.  The vector form feeds Spark ML; it uses the same vocabulary
and needs no shuffle at all once the vocabulary is known.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import cached_property

from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill import settings
from reviewmill.functions.tokens import explode_counts, with_term_counts, with_terms
from reviewmill.operators.corpus_terms import corpus_terms
from reviewmill.operators.term_rows import term_rows


@dataclass(frozen=True)
class TextFeatures:
    """How text becomes terms and which terms are kept."""

    ngrams: tuple[int, int] = (1, 2)
    min_df: int = settings.MIN_DF
    max_df: float = settings.MAX_DF
    size: int = settings.SENTIMENT_VOCABULARY
    accents: bool = True
    stop_words: list[str] | None = field(default=None)


SENTIMENT = TextFeatures()
MULTILABEL = TextFeatures(size=settings.MULTILABEL_VOCABULARY)
TOPICS = TextFeatures(ngrams=(1, 1), max_df=settings.TOPIC_MAX_DF, size=settings.TOPIC_VOCABULARY)


def ablation_features(train_rows: int, ngrams: tuple[int, int] = (1, 2)) -> TextFeatures:
    return TextFeatures(
        ngrams=ngrams, min_df=settings.MIN_DF if train_rows > 100 else 1, size=settings.ABLATION_VOCABULARY
    )


def multilabel_variant_features(train_rows: int, mode: str) -> TextFeatures:
    return TextFeatures(
        min_df=1 if train_rows < 100 else settings.MIN_DF,
        max_df=1.0,
        size=settings.MULTILABEL_VARIANT_VOCABULARY[mode],
        accents=False,
    )


def document_terms(
    df: DataFrame, features: TextFeatures = SENTIMENT, keep: tuple[str, ...] = ("review_id",), text: str = "clean_text"
) -> DataFrame:
    """(kept columns, term, tf), one row per distinct term of a review; no shuffle."""
    return explode_counts(counted_terms(df, features, keep, text), *keep)


def counted_terms(
    df: DataFrame, features: TextFeatures = SENTIMENT, keep: tuple[str, ...] = ("review_id",), text: str = "clean_text"
) -> DataFrame:
    """(kept columns, counts): the terms of a review with their counts in one array."""
    terms = with_terms(
        df.select(*keep, F.col(text)), text, "terms", features.ngrams, features.stop_words, features.accents
    ).drop(text)
    return with_term_counts(terms)


def term_statistics(doc_terms: DataFrame) -> DataFrame:
    """(term, cf, df): occurrences and reviews per term; one shuffle, combined on the map side."""
    return doc_terms.groupBy("term").agg(F.sum("tf").alias("cf"), F.count("*").alias("df"))


def corpus_statistics(df: DataFrame, features: TextFeatures = SENTIMENT, text: str = "clean_text") -> DataFrame:
    """:func:`term_statistics` of whole texts, counted in the tasks without a row per review and term."""
    return corpus_terms(df, text, features.ngrams, features.stop_words, features.accents)


def prune(statistics: DataFrame, documents: Column, features: TextFeatures = SENTIMENT) -> DataFrame:
    """The most frequent terms among those in at least ``min_df`` reviews and at most the share
    ``max_df`` of all reviews; ties by term.  The result has at most ``features.size`` rows."""
    return (
        statistics.filter(F.col("df") >= features.min_df)
        .filter(F.col("df") <= F.lit(features.max_df) * documents)
        .orderBy(F.col("cf").desc(), "term")
        .limit(features.size)
    )


def row_count(df: DataFrame) -> Column:
    """The number of rows as a value inside a lazy plan."""
    return df.select(F.count("*").alias("n")).scalar()


def vocabulary(
    df: DataFrame, features: TextFeatures = SENTIMENT, text: str = "clean_text"
) -> DataFrame:
    """(term, cf, df) of the terms kept; computed from whole texts."""
    return prune(corpus_statistics(df, features, text), row_count(df), features)


def smooth_idf(df: Column, documents: Column) -> Column:
    return F.log((F.lit(1.0) + documents) / (F.lit(1.0) + df)) + F.lit(1.0)


def idf_table(vocab: DataFrame, documents: Column) -> DataFrame:
    return vocab.select("term", smooth_idf(F.col("df"), documents).alias("idf"))


def tfidf_weights(doc_terms: DataFrame, idf: DataFrame, id_column: str = "review_id") -> DataFrame:
    """Adds ``weight`` = tf x idf, scaled to length one per review.

    ``idf`` has at most the vocabulary size of rows; the planner broadcasts it while that is small.  The length of a
    review needs its rows together; the window finds them in place when ``doc_terms`` was built from a
    table that is already partitioned by ``id_column``.
    """
    whole = Window.partitionBy(id_column)
    raw = doc_terms.join(idf, "term").withColumn("weight", F.col("tf") * F.col("idf"))
    return raw.withColumn(
        "weight", F.col("weight") / F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(whole))
    ).drop("tf", "idf")


def class_weights(df: DataFrame, label: str = "sentiment_label") -> DataFrame:
    """(label, rows, weight) with weight = n / (classes x rows of the class); null labels left out."""
    sizes = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("rows"))
    all_classes = Window.partitionBy(F.lit(0))
    return sizes.select(
        label,
        "rows",
        (F.sum("rows").over(all_classes) / (F.count("*").over(all_classes) * F.col("rows"))).alias("class_weight"),
    )


class Vectorizer:
    """Fitted text features for Spark ML: same vocabulary as :func:`vocabulary`, same weights as
    :func:`tfidf_weights`.

    ``fit`` collects the vocabulary with its document frequencies (bounded by ``features.size``),
    which already determines the idf; no second pass fits it.  ``transform`` is row-local.
    """

    def __init__(self, features: TextFeatures, terms: list[str], idf: list[float], weighting: str, output: str):
        self.features = features
        self.terms = terms
        self.idf = idf
        self.weighting = weighting
        self.output = output

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        features: TextFeatures = SENTIMENT,
        text: str = "clean_text",
        weighting: str = "tfidf",
        output: str = "features",
    ) -> Vectorizer:
        documents = df.count()
        statistics = corpus_statistics(df, features, text)
        rows = prune(statistics, F.lit(documents), features).select("term", "df").collect()
        idf = [math.log((1 + documents) / (1 + row.df)) + 1 for row in rows]
        return cls(features, [row.term for row in rows], idf, weighting, output)

    @cached_property
    def steps(self) -> list:
        """From terms to vectors.  Handing the vocabulary over term by term takes seconds, so it is done once."""
        counts = self.output if self.weighting == "counts" else "_counts"
        counted = CountVectorizerModel.from_vocabulary(self.terms, inputCol="_terms", outputCol=counts)
        if self.weighting == "counts":
            return [counted]
        weighted = ElementwiseProduct(scalingVec=Vectors.dense(self.idf), inputCol="_counts", outputCol="_weighted")
        return [counted, weighted, Normalizer(inputCol="_weighted", outputCol=self.output, p=2.0)]

    def _check(self) -> None:
        if not self.terms:
            raise ValueError("the vocabulary is empty: no term survives the frequency limits")

    def rows(self, df: DataFrame, keep: Sequence[str], text: str = "clean_text") -> DataFrame:
        """The vectors that :meth:`transform` makes, as packed rows whose scale is ``idf`` (see ``passes.Sparse``)."""
        self._check()
        if self.weighting != "tfidf":
            raise ValueError(f"packed rows are weighted by tf-idf, not by {self.weighting}")
        f = self.features
        return term_rows(df, keep, self.terms, self.idf, text, f.stop_words, f.accents)

    def transform(self, df: DataFrame, text: str = "clean_text") -> DataFrame:
        self._check()
        f = self.features
        vectors = with_terms(df, text, "_terms", f.ngrams, f.stop_words, f.accents)
        for step in self.steps:
            vectors = step.transform(vectors)
        return vectors.drop("_terms", "_counts", "_weighted")
