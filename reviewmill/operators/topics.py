"""Topic mining and the roll-ups built on it.

The roll-ups take two tables, whatever made the topics: documents (``review_id``, ``clean_text``,
``topic_id``, ``topic_weight``, optionally ``sentiment_label`` and ``course_id``) and keywords
(``topic_id``, ``position`` from 1, ``term``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill import settings
from reviewmill.operators import lda
from reviewmill.operators.features import TOPICS, TextFeatures, Vectorizer
from reviewmill.operators.passes import stored_rows


def topic_count(documents: int, max_topics: int, vocabulary_size: int) -> int:
    """Fixed rule: two topics below 100 documents, from there one per 50; at least two, at most ``max_topics`` (but never
    below two), and one per term at most."""
    wanted = documents // 50 if documents >= 100 else 2
    if wanted > max_topics:
        wanted = max_topics
    if wanted < 2:
        wanted = 2
    return min(wanted, max(1, vocabulary_size))


@dataclass(frozen=True)
class Topics:
    count: int
    documents: DataFrame
    keywords: DataFrame


def fit_topics(
    df: DataFrame,
    max_topics: int = settings.TOPIC_COUNT["full"],
    features: TextFeatures = TOPICS,
    iterations: int = settings.TOPIC_ITERATIONS,
    seed: int = settings.SEED,
) -> Topics | None:
    """LDA over unigram counts, every review in every pass; None below the minimum number of documents."""
    documents = df.count()
    if documents < settings.MIN_TOPIC_DOCUMENTS:
        return None
    vectorizer = Vectorizer.fit(df, features, weighting="counts")
    width = len(vectorizer.terms)
    k = topic_count(documents, max_topics, width)
    # Written once: each pass reads it, the assignment once more.
    counted = stored_rows(vectorizer.transform(df), df.columns)
    if k == 1:
        assigned = counted.drop("indices", "values").withColumn("topicDistribution", F.array(F.lit(1.0)))
        top = [list(range(min(settings.TOPIC_KEYWORDS, width)))]
    else:
        model = lda.fit(counted, k, width, iterations, seed)
        assigned = model.assigned(counted)
        top = model.top_terms(settings.TOPIC_KEYWORDS)
    keywords = df.sparkSession.createDataFrame(
        [(topic, i + 1, vectorizer.terms[term]) for topic, terms in enumerate(top) for i, term in enumerate(terms)],
        "topic_id int, position int, term string",
    )
    return Topics(k, dominant_topic(assigned, k), keywords)


def dominant_topic(df: DataFrame, k: int, distribution: str = "topicDistribution") -> DataFrame:
    """Add ``topic_id`` (largest share, first on ties) and ``topic_weight``.  A review without any
    known term has no distribution; all topics are equally likely for it."""
    known = F.array_max(distribution) > 0
    return (
        df.withColumn("topic_id", F.array_position(distribution, F.array_max(distribution)).cast("int") - 1)
        .withColumn("topic_weight", F.when(known, F.array_max(distribution)).otherwise(F.lit(1.0 / k)))
    )


def top_keywords(term_weights: DataFrame, n: int = settings.TOPIC_KEYWORDS) -> DataFrame:
    """From (topic_id, term, weight) to (topic_id, position, term), heaviest first, ties by term."""
    window = Window.partitionBy("topic_id").orderBy(F.col("weight").desc(), "term")
    return (
        term_weights.withColumn("position", F.row_number().over(window))
        .filter(F.col("position") <= n)
        .select("topic_id", "position", "term", "weight")
    )


def keyword_text(keywords: DataFrame, n: int = settings.TOPIC_KEYWORDS) -> DataFrame:
    """(topic_id, keywords): the first ``n`` keywords joined by a comma."""
    pairs = F.sort_array(F.collect_list(F.struct("position", "term")))
    return (
        keywords.filter(F.col("position") <= n)
        .groupBy("topic_id")
        .agg(F.array_join(F.transform(pairs, lambda p: p.term), ", ").alias("keywords"))
    )


def topic_diversity(keywords: DataFrame) -> DataFrame:
    """One row: distinct keywords over all keywords."""
    return keywords.agg((F.count_distinct("term") / F.count("*")).alias("topic_diversity"))


def representatives(documents: DataFrame, id_column: str = "review_id") -> DataFrame:
    """(topic_id, representative): text of the review with the highest topic weight (ties: lowest id, then lowest
    text), one row per topic.  One aggregate: each task sends the start of one text per topic."""
    start = F.substring("clean_text", 1, settings.REPRESENTATIVE_CHARS)
    best = F.min(F.struct((-F.col("topic_weight")).alias("w"), F.col(id_column).alias("id"), start.alias("text")))
    return documents.groupBy("topic_id").agg(best.alias("best")).select("topic_id", F.col("best.text").alias("representative"))


def topic_sentiment(documents: DataFrame) -> DataFrame:
    """Reviews per (topic, sentiment); a missing label is a group of its own."""
    return documents.groupBy("topic_id", "sentiment_label").agg(F.count("*").alias("document_count"))


def topic_sentiment_pivot(documents: DataFrame, labels: tuple[str, ...] = tuple(settings.THREE_CLASSES)) -> DataFrame:
    counts = documents.groupBy("topic_id").pivot("sentiment_label", list(labels)).agg(F.count(F.lit(1)))
    return counts.na.fill(0, list(labels))


def document_topics(documents: DataFrame) -> DataFrame:
    columns = [c for c in ("review_id", "clean_text", "topic_id", "sentiment_label", "course_id") if c in documents.columns]
    table = documents.select(*columns)
    if "sentiment_label" not in columns:
        table = table.withColumn("sentiment_label", F.lit(settings.NO_SENTIMENT))
    return table


def topic_profile(documents: DataFrame, topics: DataFrame) -> DataFrame:
    """Size, most frequent sentiment (ties: first in the alphabet) and share of negatives per topic.
    Missing labels stay in the denominator; topics without reviews are kept."""
    if "sentiment_label" not in documents.columns:
        documents = documents.withColumn("sentiment_label", F.lit(None).cast("string"))
        negative = F.lit(None).cast("double")
    else:
        is_negative = F.col("sentiment_label") == "negative"
        negative = F.sum(F.when(is_negative, F.col("document_count")).otherwise(0)) / F.sum("document_count")
    # (count, label) pairs of one topic: a handful of labels.
    ranked = F.sort_array(
        F.collect_list(
            F.when(
                F.col("sentiment_label").isNotNull(),
                F.struct((-F.col("document_count")).alias("n"), F.col("sentiment_label").alias("label")),
            )
        )
    )
    profile = topic_sentiment(documents).groupBy("topic_id").agg(
        F.sum("document_count").alias("document_count"),
        F.get(ranked, 0).getField("label").alias("dominant_sentiment"),
        negative.alias("negative_ratio"),
    )
    return topics.join(profile, "topic_id", "left").select(
        "topic_id",
        F.coalesce("document_count", F.lit(0)).alias("document_count"),
        F.coalesce("dominant_sentiment", F.lit(settings.NO_SENTIMENT)).alias("dominant_sentiment"),
        "negative_ratio",
    )


def issue_action(text: Column) -> tuple[Column, Column]:
    """Likely issue and suggested action: the first rule whose word occurs in the text."""
    lower = F.lower(text)
    issue, action = F.lit(settings.GENERAL_ISSUE[0]), F.lit(settings.GENERAL_ISSUE[1])
    for word, rule_issue, rule_action in reversed(settings.ISSUE_RULES):
        found = F.contains(lower, F.lit(word))
        issue = F.when(found, F.lit(rule_issue)).otherwise(issue)
        action = F.when(found, F.lit(rule_action)).otherwise(action)
    return issue, action


def _topic_table(documents: DataFrame, keywords: DataFrame, k: int) -> DataFrame:
    topics = documents.sparkSession.range(k).select(F.col("id").cast("int").alias("topic_id"))
    return (
        topic_profile(documents, topics)
        .join(representatives(documents), "topic_id", "left")
        .withColumn("representative", F.coalesce("representative", F.lit("")))
    )


def topic_summary(documents: DataFrame, keywords: DataFrame, k: int) -> DataFrame:
    return (
        _topic_table(documents, keywords, k)
        .join(keyword_text(keywords), "topic_id", "left")
        .select(
            "topic_id",
            F.coalesce("keywords", F.lit("")).alias("keywords"),
            "document_count",
            F.col("representative").alias("representative_comment"),
            "dominant_sentiment",
            "negative_ratio",
            topic_diversity(keywords).scalar().alias("topic_diversity"),
            F.lit(settings.BERTOPIC_STATUS).alias("bertopic_status"),
            F.lit(settings.TOPIC_NOTE).alias("notes"),
        )
    )


def improvement_matrix(documents: DataFrame, keywords: DataFrame, k: int) -> DataFrame:
    """Per topic: six keywords, sentiment, an example and what it suggests to improve.  The issue is
    looked up in all keywords, not only the six shown."""
    shown = keyword_text(keywords, settings.MATRIX_KEYWORDS)
    every = keyword_text(keywords).withColumnRenamed("keywords", "_every")
    issue, action = issue_action(F.coalesce("_every", F.lit("")))
    return (
        _topic_table(documents, keywords, k)
        .join(shown, "topic_id", "left")
        .join(every, "topic_id", "left")
        .select(
            "topic_id",
            F.coalesce("keywords", F.lit("")).alias("keywords"),
            "dominant_sentiment",
            "negative_ratio",
            F.col("representative").alias("representative_comments"),
            issue.alias("likely_teaching_issue"),
            action.alias("suggested_teaching_improvement_action"),
        )
    )


def too_few_documents(df: DataFrame, documents: int) -> DataFrame:
    """The summary row that stands in when there is too little text."""
    row = ("not_run", "", documents, "", None, "Not enough documents for topic modeling.")
    return df.sparkSession.createDataFrame(
        [row],
        "topic_id string, keywords string, document_count long, representative_comment string, "
        "topic_diversity double, notes string",
    )
