from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reviewmill import settings
from reviewmill.operators import cleaning, errors, guards, labeling, summaries, topics


@pytest.fixture(scope="module")
def documents(spark):
    rows = [
        (1, "first text", "positive", "c1", 0, 0.9),
        (2, "second text", "negative", "c1", 0, 0.9),
        (3, "third text", None, "c2", 0, 0.1),
        (4, "fourth " + "x" * 600, "negative", "c2", 2, 0.5),
        (5, "fifth", None, None, 3, 0.5),
    ]
    schema = "review_id long, clean_text string, sentiment_label string, course_id string, topic_id int, topic_weight double"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def keywords(spark):
    terms = {0: ["video", "week"], 2: ["quiz", "assignment"], 3: ["week", "other"]}
    rows = [(t, i + 1, w) for t, ws in terms.items() for i, w in enumerate(ws)]
    return spark.createDataFrame(rows, "topic_id int, position int, term string")


def test_topic_summary(documents, keywords):
    rows = {r.topic_id: r for r in topics.topic_summary(documents, keywords, 4).collect()}
    assert sorted(rows) == [0, 1, 2, 3]
    assert (rows[0].document_count, rows[0].representative_comment, rows[0].keywords) == (3, "first text", "video, week")
    assert rows[0].dominant_sentiment == "negative"  # one each: the first in the alphabet
    assert rows[0].negative_ratio == pytest.approx(1 / 3)  # the missing label counts below the line
    assert (rows[1].document_count, rows[1].representative_comment, rows[1].negative_ratio) == (0, "", None)
    assert rows[1].dominant_sentiment == rows[3].dominant_sentiment == settings.NO_SENTIMENT
    assert len(rows[2].representative_comment) == 500
    assert rows[0].topic_diversity == pytest.approx(5 / 6)


def test_topic_summary_without_labels(documents, keywords):
    rows = {r.topic_id: r for r in topics.topic_summary(documents.drop("sentiment_label"), keywords, 4).collect()}
    assert rows[0].dominant_sentiment == settings.NO_SENTIMENT and rows[0].negative_ratio is None
    table = topics.document_topics(documents.drop("sentiment_label")).first()
    assert table.sentiment_label == settings.NO_SENTIMENT


def test_improvement_matrix(documents, keywords):
    rows = {r.topic_id: r for r in topics.improvement_matrix(documents, keywords, 4).collect()}
    assert rows[0].likely_teaching_issue == "Lecture pacing or video clarity"
    # Both words occur: the order of the rules decides, not the order of the keywords.
    assert rows[2].likely_teaching_issue == "Assessment design or peer review clarity"
    assert rows[3].likely_teaching_issue == settings.GENERAL_ISSUE[0]


def test_topic_counts_and_pivot(documents):
    counts = {(r.topic_id, r.sentiment_label): r.document_count for r in topics.topic_sentiment(documents).collect()}
    assert counts == {(0, "positive"): 1, (0, "negative"): 1, (0, None): 1, (2, "negative"): 1, (3, None): 1}
    pivot = {r.topic_id: (r.negative, r.neutral, r.positive) for r in topics.topic_sentiment_pivot(documents).collect()}
    assert pivot == {0: (1, 0, 1), 2: (1, 0, 0), 3: (0, 0, 0)}


def test_number_of_topics():
    assert [topics.topic_count(n, 8, 5000) for n in (20, 99, 100, 150, 399, 400, 10**6)] == [2, 2, 2, 3, 7, 8, 8]
    assert topics.topic_count(1000, 8, 3) == 3 and topics.topic_count(1000, 8, 0) == 1


def test_dominant_topic_ties_and_empty(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4],), ([0.0, 0.0, 0.0],)], "topicDistribution array<double>")
    rows = topics.dominant_topic(df, 3).collect()
    assert [(r.topic_id, round(r.topic_weight, 6)) for r in rows] == [(1, 0.4), (0, round(1 / 3, 6))]


def test_lda(reviews):
    cleaned = cleaning.preprocess(labeling.add_labels(reviews))
    assert topics.fit_topics(cleaned.limit(19)) is None
    row = topics.too_few_documents(cleaned, 19).first()
    assert row.topic_id == "not_run" and row.document_count == 19
    found = topics.fit_topics(cleaned, 5)
    assert found.count == 2 and found.documents.count() == cleaned.count()
    for r in found.documents.collect():
        assert 0 <= r.topic_id < 2 and abs(sum(r.topicDistribution) - 1) < 1e-6
    assert found.keywords.filter("topic_id = 0").count() == 10
    again = topics.fit_topics(cleaned, 5)
    assert sorted(found.keywords.collect()) == sorted(again.keywords.collect())


def test_error_types(spark):
    cases = [
        ("positive", "negative", "any", "positive_predicted_as_negative"),
        ("negative", "positive", "any", "negative_predicted_as_positive"),
        ("neutral", "positive", "any", "neutral_confusion"),
        ("Positive", "Negative", "one two　three\nfour five", "short_review"),
        ("Positive", "Negative", "an attribute of every course here was nice", "mixed_sentiment"),
        ("Positive", "Negative", "five words and then one more", "other_sentiment_error"),
        ("Positive", "Positive", "right", None),
    ]
    rows = [("m", i, "c", text, t, p) for i, (t, p, text, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "model string, review_id int, course_id string, clean_text string, true_label string, predicted_label string")
    got = {r.review_id: r.error_type for r in errors.sentiment_errors(df).collect()}
    assert got == {i: c[3] for i, c in enumerate(cases) if c[3]}
    assert errors.error_cases(df, None, limit=2).count() == 2
    right = df.filter("true_label = predicted_label")
    assert errors.error_cases(right, None).first().error_type == "not_run"


def test_error_cases_of_every_model(spark):
    df = spark.range(500).select(
        F.concat(F.lit("m"), (F.col("id") % 2).cast("string")).alias("model"),
        F.col("id").alias("review_id"),
        F.lit("text").alias("clean_text"),
        F.lit("positive").alias("true_label"),
        F.lit("negative").alias("predicted_label"),
    )
    flags = df.select("review_id", "clean_text", F.lit("a; b").alias("true_labels"), F.lit("a").alias("predicted_labels"))
    cases = errors.error_cases(df, flags)
    assert {r.model: r["count"] for r in cases.groupBy("model").count().collect()} == {"m0": 30, "m1": 30, settings.OVR_NAME: 30}
    first = errors.first_cases(errors.sentiment_errors(df), 30).filter("model = 'm1'").agg(F.max("review_id")).first()[0]
    assert first == 59


def test_guard(spark):
    rows = [("x", i, "t", "positive" if i % 2 else "negative", "train" if i < 20 else "test") for i in range(25)]
    rows += [("y", i, "t", "positive", "train") for i in range(5)]
    df = spark.createDataFrame(rows, "course_id string, review_id int, clean_text string, sentiment_label string, split string")
    got = {r.course_id: (r.sentiment_status, r.topic_status) for r in guards.run_guard(df, ["course_id"]).collect()}
    assert got == {"x": ("run", "run"), "y": ("not_run", "not_run")}


def test_summaries(spark, documents):
    labelled = documents.withColumn("label_5class", F.initcap("sentiment_label"))
    rows = summaries.label_distribution(labelled, "s").collect()
    assert [(r.label_type, r.label, r["count"]) for r in rows] == [
        ("3class", "negative", 2), ("3class", "positive", 1), ("5class", "Negative", 2), ("5class", "Positive", 1),
    ]
    assert summaries.unlabelled_distribution(documents, labeling.NO_LABELS).first()["count"] == 5
    top = summaries.course_sentiment(documents, 2).collect()
    assert [(r.course_id, r.sentiment_label) for r in top] == [("c1", "negative"), ("c1", "positive")]
    flags = spark.createDataFrame([(1, 0), (1, None)], "`a b` int, c int")
    assert {r.label: r.positive_count for r in summaries.flag_distribution(flags, ["a b", "c", "d"]).collect()} == {"a b": 2, "c": 0}


def test_repeated_ids_give_one_representative(spark):
    rows = [(1, "first", 0, 0.5), (1, "second", 0, 0.9), (1, "third", 0, 0.9), (2, "other", 1, 0.1)]
    df = spark.createDataFrame(rows, "review_id long, clean_text string, topic_id int, topic_weight double")
    assert {tuple(r) for r in topics.representatives(df).collect()} == {(0, "second"), (1, "other")}


def test_error_table_without_predictions(spark):
    row = errors.error_cases(None, None).first()
    assert row.error_type == "not_run" and row.task == "not_available"


def test_error_cases_with_repeated_ids(spark):
    rows = [("m", i // 40, "text", "positive", "negative") for i in range(120)]
    df = spark.createDataFrame(rows, "model string, review_id long, clean_text string, true_label string, predicted_label string")
    assert errors.first_cases(errors.sentiment_errors(df), 30).count() == 30


def test_more_passes_make_a_better_topic_model(spark):
    """Two separate vocabularies: after ten passes the reviews of each sit in one topic."""
    words = ["alpha beta gamma delta", "river stone meadow cloud"]
    df = spark.createDataFrame([(i, " ".join([words[i % 2]] * 3)) for i in range(90)], "review_id long, clean_text string")
    documents = topics.fit_topics(df, 2).documents.collect()
    groups = {(r.review_id % 2, r.topic_id) for r in documents}
    assert len(groups) == 2 and sum(r.topic_weight for r in documents) / len(documents) > 0.9
