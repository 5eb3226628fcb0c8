"""Cleaning, empty-text filter and first-row-wins deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.functions.text import MARKS, clean_text, has_content, masked_text


def drop_empty(df: DataFrame, text: str = "review_text") -> DataFrame:
    return df.filter(has_content(F.col(text)))


def first_per_text(
    df: DataFrame, order_by: Sequence[str | Column], text: str = "clean_text"
) -> DataFrame:
    """Keep the first row of every distinct text in the given order.

    The 64-bit hash in front of the text makes the sort compare longs; the text itself stays in
    the key, so two texts with one hash are not mixed up.  Ranking with a limit of one is applied
    before the shuffle too, so a text that makes up a third of all rows sends one row per task.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    window = Window.partitionBy(F.xxhash64(text), F.col(text)).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def preprocess(
    df: DataFrame, order_by: Sequence[str | Column] = ("review_id",), any_case_names: bool = False
) -> DataFrame:
    """Add ``clean_text``, drop rows it leaves empty, keep the first row per cleaned text."""
    if "review_text" not in df.columns:
        raise ValueError("preprocess needs a review_text column")
    cleaned = drop_empty(df).withColumn("clean_text", clean_text(F.col("review_text"), any_case_names))
    return first_per_text(cleaned, order_by)


def removed_rows(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Rows before, rows after and rows removed by :func:`preprocess`, per group of ``keys``.

    Counts need no texts: each row is reduced to a 256-bit digest before the shuffle.
    """
    digest = F.when(has_content(F.col("review_text")), F.sha2(clean_text(F.col("review_text")), 256))
    per_text = df.select(*keys, digest.alias("digest")).groupBy(*keys, "digest").agg(F.count("*").alias("rows"))
    before, after = F.sum("rows"), F.count("digest")
    return per_text.groupBy(*keys).agg(
        F.coalesce(before, F.lit(0)).cast("long").alias("rows_before"),
        after.alias("rows_after"),
        (F.coalesce(before, F.lit(0)) - after).cast("long").alias("removed_rows"),
    )


def mask_counts(df: DataFrame, keys: Sequence[str] = (), text: str = "review_text") -> DataFrame:
    """Per mark: how many texts carry it after masking and how often it occurs in all."""
    masked = df.select(*keys, masked_text(F.col(text)).alias("_masked"), F.col(text).alias("_raw"))
    aggregates = []
    for name, mark in MARKS.items():
        # A text may hold the mark literally, so count what masking added.
        added = _occurrences("_masked", mark) - _occurrences("_raw", mark)
        aggregates.append(F.coalesce(F.sum((added > 0).cast("long")), F.lit(0)).alias(f"{name}_rows"))
        aggregates.append(F.coalesce(F.sum(added), F.lit(0)).alias(f"{name}_marks"))
    wide = masked.groupBy(*keys).agg(*aggregates)
    entries = ", ".join(f"'{name}', {name}_rows, {name}_marks" for name in MARKS)
    return wide.selectExpr(*keys, f"stack({len(MARKS)}, {entries}) as (mask, rows_masked, marks)")


def _occurrences(column: str, literal: str) -> Column:
    text = F.coalesce(F.col(column), F.lit(""))
    shorter = F.replace(text, F.lit(literal), F.lit(""))
    return ((F.length(text) - F.length(shorter)) / len(literal)).cast("long")
