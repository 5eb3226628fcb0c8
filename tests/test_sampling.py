"""Samples and splits against a plain sort of all rows."""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from reviewmill.operators import sampling


def key(value, seed=42):
    return hashlib.md5(f"{value}:{seed}".encode()).hexdigest()


def largest_remainder(counts: dict, total: int) -> dict:
    n = sum(counts.values())
    exact = {k: c * total / n for k, c in counts.items()}
    whole = {k: math.floor(e) for k, e in exact.items()}
    order = sorted(counts, key=lambda k: (-round(exact[k] - whole[k], 9), k))
    for k in order[: total - sum(whole.values())]:
        whole[k] += 1
    return whole


def table(spark, sizes):
    rows, i = [], 0
    for label, size in sizes.items():
        for _ in range(size):
            rows.append((i, label, f"text {i}", f"c{i % 11}"))
            i += 1
    return spark.createDataFrame(rows, "review_id long, sentiment_label string, clean_text string, course_id string"), rows


def test_sample_is_the_n_smallest_hashes(spark):
    df, rows = table(spark, {"a": 700})
    want = sorted(range(700), key=key)[:123]
    assert sorted(r.review_id for r in sampling.sample_rows(df, 123).collect()) == sorted(want)
    assert sampling.sample_rows(df, 5000).count() == 700
    assert sampling.sample_rows(df.limit(0), 5).count() == 0


def test_split_sizes_and_order(spark):
    sizes = {"positive": 331, "neutral": 47, "negative": 22}
    df, rows = table(spark, sizes)
    n = sum(sizes.values())
    keep = n - math.ceil(0.2 * n)
    rest = largest_remainder(sizes, keep)
    train = largest_remainder(rest, keep - math.ceil(0.125 * keep))
    want = {}
    for label, size in sizes.items():
        ids = sorted((r[0] for r in rows if r[1] == label), key=key)
        for rank, i in enumerate(ids):
            want[i] = "test" if rank < size - rest[label] else "val" if rank < size - train[label] else "train"
    got = {r.review_id: r.split for r in sampling.split_rows(df).collect()}
    assert got == want
    assert Counter(got.values())["test"] == math.ceil(0.2 * n)


def test_split_of_36_rows(spark):
    df, _ = table(spark, {"positive": 12, "neutral": 12, "negative": 12})
    sizes = Counter(r.split for r in sampling.split_rows(df).collect())
    assert sizes == {"train": 24, "val": 4, "test": 8}


def test_split_with_null_and_tiny_classes(spark):
    df, rows = table(spark, {"a": 30, None: 10})
    by_class = defaultdict(Counter)
    for r in sampling.split_rows(df).collect():
        by_class[r.sentiment_label][r.split] += 1
    assert by_class[None] == {"train": 7, "val": 1, "test": 2}
    # One class with a single row: no stratification, sizes still exact.
    df, _ = table(spark, {"a": 39, "b": 1})
    assert Counter(r.split for r in sampling.split_rows(df).collect()) == {"train": 28, "val": 4, "test": 8}
    check = sampling.stratify_check(df, "sentiment_label").first()
    assert (check.classes, check.smallest, check.usable) == (2, 1, False)


def test_skewed_class(spark):
    """One class holds nearly everything; borders are still exact."""
    df = spark.range(20000).select(
        F.col("id").alias("review_id"), F.when(F.col("id") < 19000, "big").otherwise("small").alias("sentiment_label")
    )
    sizes = {(r.sentiment_label, r.split): r["rows"] for r in sampling.split_sizes(sampling.split_rows(df), "sentiment_label").collect()}
    assert sizes == {
        ("big", "test"): 3800, ("big", "val"): 1900, ("big", "train"): 13300,
        ("small", "test"): 200, ("small", "val"): 100, ("small", "train"): 700,
    }


def test_balanced_sample(spark):
    df, rows = table(spark, {"a": 50, "b": 7})
    df = df.withColumn("clean_text", F.when(F.col("review_id") != 3, F.col("clean_text")))
    got = sampling.balanced_sample(df, 10).collect()
    want = {i for label in "ab" for i in sorted((r[0] for r in rows if r[1] == label and r[0] != 3), key=key)[:10]}
    assert {r.review_id for r in got} == want


def test_course_holdout(spark):
    df, rows = table(spark, {"a": 60})
    df = df.withColumn("course_id", F.when(F.col("review_id") != 5, F.col("course_id")))
    held = sorted({f"c{i}" for i in range(11)}, key=key)[:2]
    for r in sampling.course_holdout(df).collect():
        assert r.split == ("test" if r.course_id in held else "train")
    assert sampling.course_holdout(df.filter("course_id = 'c1'")) is None
    assert sampling.course_holdout(df.filter("course_id in ('c1', 'c2')"), min_courses=5) is None


def test_stratify_column(spark):
    df = spark.createDataFrame([(0,), (1,)], "not_praise int")
    assert sampling.choose_stratify_column(df, True) == "sentiment_label"
    assert sampling.choose_stratify_column(df, False) == "not_praise"
    assert sampling.choose_stratify_column(df.limit(1), False) is None


def test_null_repeated_and_text_ids_keep_sizes_exact(spark):
    ids = [None] * 20 + ["same"] * 30 + [f"t{i}" for i in range(50)]
    df = spark.createDataFrame([(r, "ab"[i % 2], f"text {i}") for i, r in enumerate(ids)], "review_id string, sentiment_label string, clean_text string")
    assert sampling.sample_rows(df, 15).count() == 15 and sampling.sample_rows(df, 1000).count() == 100
    balanced = sampling.balanced_sample(df, 7).groupBy("sentiment_label").count().collect()
    assert sorted(r["count"] for r in balanced) == [7, 7]
    sizes = {r.split: r["count"] for r in sampling.split_rows(df).groupBy("split").count().collect()}
    assert sizes == {"test": 20, "val": 10, "train": 70}


def test_any_number_of_strata(spark):
    df = spark.range(240_000).select(F.col("id").alias("review_id"), (F.col("id") % 120_000).cast("string").alias("sentiment_label"))
    sizes = {r.split: r["count"] for r in sampling.split_rows(df).groupBy("split").count().collect()}
    assert sizes == {"test": 48_000, "val": 24_000, "train": 168_000}
    assert sampling.balanced_sample(df, 1, required=()).count() == 120_000


def test_a_class_too_small_for_the_second_cut(spark):
    """Two rows of a class, one of them in test: train and val are then cut without regard to classes."""
    df = spark.createDataFrame([(i, "big" if i > 1 else "pair") for i in range(12)], "review_id long, sentiment_label string")
    rows = sampling.split_rows(df).collect()
    sizes = {s: sum(r.split == s for r in rows) for s in ("test", "val", "train")}
    assert sizes == {"test": 3, "val": 2, "train": 7}
