"""Masks, cleaning, labels: fixed examples and random texts against Python's own regex engine."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from reviewmill import settings
from reviewmill.functions.labels import label_3class, label_5class, sentiment_from_rating
from reviewmill.functions.numbers import to_flag, to_number, whole_number_text
from reviewmill.functions.text import clean_text, has_content, masked_text
from reviewmill.operators import cleaning, labeling


def apply(spark, expression, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression(F.col("v"))).collect()]


def test_contact_data_is_masked(spark):
    raw = "Write to learner@school.org or see https://school.org/a?b=1. Phone +1 555-123-4567, my name is Ann Lee."
    assert apply(spark, clean_text, [raw]) == [
        "Write to [EMAIL] or see [URL]. Phone [PHONE], my name is [NAME]."
    ]


def test_masks_at_the_edges(spark):
    cases = {
        "I am John": "I am John",  # the cue counts in lower case only
        "i am John": "i am [NAME]",
        "i'm Zoé": "i'm Zoé",
        "WWW.site.ORG!": "[URL]!",
        "on 2024-01-01 10": "on [PHONE]",
        "a 　b\x1cc": "a b c",
        "  \n\t ": "",
        None: "",
        "seen 12 34": "seen 12 34",
    }
    assert apply(spark, clean_text, list(cases)) == list(cases.values())
    assert apply(spark, lambda c: masked_text(c, any_case_names=True), ["I AM John Doe x"]) == ["I AM [NAME] x"]


def test_random_texts_agree_with_python(spark):
    """Pieces chosen so that masks overlap, touch and meet non-ASCII letters and spaces."""
    pieces = [
        "i am", "I am", "my name is", " ", "  ", " ", " ", "　", "\x1c", "\n", "John", "Smith", "é", "i'm",
        "www.", "WwW.", "http://", "HTTPS://", "a.b", "x@y.com", ".", "@", "-", "+", "1", "23456789", "(555)", "12-34",
        "٣", "²", "_", "́", "/p?q=1", "!", "ſ",
    ]
    rng = random.Random(7)
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 14))) for _ in range(5000)]
    # --- fixed values: the mask patterns as the results define them ---
    url = re.compile(r"\b(?:https?://|www\.)\S+\b", re.IGNORECASE)
    email = re.compile(r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b")
    phone = re.compile(r"\+?\d[\d\s().-]{7,}\d")
    name = re.compile(r"\b(my name is|i am|i'm)\s+[A-Z][A-Za-z]+(?:\s+[A-Z][A-Za-z]+)?\b")

    def expected(text):
        for pattern, mark in ((url, "[URL]"), (email, "[EMAIL]"), (phone, "[PHONE]"), (name, r"\1 [NAME]")):
            text = pattern.sub(mark, text)
        return " ".join(text.split())

    want = [expected(t) for t in texts]
    assert apply(spark, clean_text, texts) == want
    assert apply(spark, has_content, texts) == [w != "" for w in want]


def test_labels(spark):
    values = ["5", "4.0", " 3 ", "2", "1", "Very Positive", "NEGATIVE", "5.00", "4.5", "pos", None, "", "6", " 5\n"]
    assert apply(spark, label_5class, values) == [
        "Very Positive", "Positive", "Neutral", "Negative", "Very Negative", "Very Positive", "Negative",
        None, None, None, None, None, None, "Very Positive",
    ]
    assert apply(spark, label_3class, values[:5]) == ["positive", "positive", "neutral", "negative", "negative"]
    assert apply(spark, lambda c: label_3class(c, short_spellings=True), ["pos", "NEG"]) == ["positive", "negative"]
    assert apply(spark, label_5class, [5.0, 4.5], "double") == ["Very Positive", None]


def test_ratings(spark):
    values = [5.0, 4.0, 3.5, 3.0, 2.5, 2.0, -1.0, None]
    assert apply(spark, sentiment_from_rating, values, "double") == [
        "positive", "positive", None, "neutral", None, "negative", "negative", None,
    ]


def test_numbers(spark):
    values = ["1", " 2.5 ", "-3e2", "x", "", None, "5d", "nan", ".5"]
    assert apply(spark, to_number, values) == [1.0, 2.5, -300.0, None, None, None, None, None, 0.5]
    assert apply(spark, to_flag, ["1", "1.0", "x", None, "0", "1e300", "-1e300"]) == [1, 1, 0, 0, 0, 0, 0]
    assert apply(spark, whole_number_text, ["5.00", " 4 ", "4.5", "x", None, "1e300"]) == ["5", "4", "4.5", "x", None, "1e300"]


def test_preprocess_keeps_first_of_each_text(spark):
    rows = [(3, "Slides  were dense", "c"), (1, "Slides were dense", "a"), (2, "\t \n", "b"), (4, None, "d"), (5, "No exam", "e")]
    df = spark.createDataFrame(rows, "review_id long, review_text string, course_id string")
    kept = {(r.review_id, r.clean_text, r.course_id) for r in cleaning.preprocess(df).collect()}
    assert kept == {(1, "Slides were dense", "a"), (5, "No exam", "e")}
    report = cleaning.removed_rows(df).first()
    assert (report.rows_before, report.rows_after, report.removed_rows) == (5, 2, 3)
    with pytest.raises(ValueError):
        cleaning.preprocess(df.drop("review_text"))


def test_preprocess_with_one_text_in_most_rows(spark):
    """A copy that makes up most of the table goes through the shuffle once per task."""
    df = spark.range(20000).select(
        F.col("id").alias("review_id"),
        F.when(F.col("id") % 3 < 2, F.lit("same words")).otherwise(F.concat(F.lit("t"), "id")).alias("review_text"),
    )
    kept = cleaning.preprocess(df)
    assert kept.count() == 1 + 6666
    assert kept.filter("clean_text = 'same words'").first().review_id == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_label_sources(spark):
    explicit = spark.createDataFrame([("a", "Very Positive"), ("b", "nonsense")], "review_text string, explicit_label string")
    df, info = labeling.construct_sentiment_labels(explicit)
    assert info.source == "explicit_label" and [r.sentiment_label for r in df.collect()] == ["positive"]
    rated = spark.createDataFrame([("fast", "?", 4), ("slow", None, 3), ("dull", "", 2)], "review_text string, explicit_label string, rating int")
    df, info = labeling.construct_sentiment_labels(rated)
    assert info.source == "rating"
    assert {(r.review_text, r.sentiment_label) for r in df.collect()} == {("fast", "positive"), ("slow", "neutral"), ("dull", "negative")}
    df, info = labeling.construct_sentiment_labels(spark.createDataFrame([("a",)], "review_text string"))
    assert not info.available and df.count() == 1


def test_rating_is_no_feature(spark):
    df = spark.createDataFrame([("good", 5)], "clean_text string, rating int")
    assert labeling.feature_columns(df) == ["clean_text"]
    assert settings.THREE_CLASSES == ["negative", "neutral", "positive"]
