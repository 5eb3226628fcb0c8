"""From a raw table with whatever column names to the review schema."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill import settings
from reviewmill.functions.numbers import to_flag, to_number


def first_existing(columns: Sequence[str], candidates: Sequence[str]) -> str | None:
    """The best candidate that is a column: exact name first, then any case, candidate by candidate."""
    any_case = {c.lower(): c for c in columns}
    hits = (c if c in columns else any_case.get(c.lower()) for c in candidates)
    return next((hit for hit in hits if hit is not None), None)


def numeric_share(column: Column) -> Column:
    """Share of values that read as a number; nulls count as not numeric."""
    return F.coalesce(F.avg(to_number(column).isNotNull().cast("double")), F.lit(0.0))


def label_is_rating(df: DataFrame, label: str) -> bool:
    """More than 90% numbers: the label column really holds ratings.  One aggregate over one column."""
    return df.agg(numeric_share(F.col(f"`{label}`"))).first()[0] > settings.NUMERIC_LABEL_SHARE


def flag_columns(df: DataFrame, flags: Sequence[str]) -> list[Column]:
    return [to_flag(F.col(f"`{f}`")).alias(f) for f in flags if f in df.columns]


def normalize_reviews(
    df: DataFrame,
    source_dataset: str,
    source_platform: str,
    source_file: str,
    row_id: str | Column = "source_row_id",
    flags: Sequence[str] = tuple(settings.FEEDBACK_FLAGS),
) -> DataFrame:
    """Project a raw table onto the review columns it has.

    Only the choice between rating and label may need a job; all else is decided on column names.
    """
    text = first_existing(df.columns, settings.TEXT_CANDIDATES)
    if text is None:
        raise ValueError(f"no review text column in {source_file}")
    rating = first_existing(df.columns, settings.RATING_CANDIDATES)
    label = first_existing(df.columns, settings.LABEL_CANDIDATES)
    course = first_existing(df.columns, settings.COURSE_CANDIDATES)

    def column(name: str) -> Column:
        return F.col(f"`{name}`")

    out = [
        column(text).cast("string").alias("review_text"),
        F.lit(source_dataset).alias("source_dataset"),
        F.lit(source_platform).alias("source_platform"),
        F.lit(source_file).alias("source_file"),
        (column(row_id) if isinstance(row_id, str) else row_id).cast("long").alias("source_row_id"),
    ]
    if rating is not None:
        out.append(to_number(column(rating)).alias("rating"))
    if label is not None:
        if rating is None and label_is_rating(df, label):
            out.append(to_number(column(label)).alias("rating"))
        else:
            out.append(column(label).cast("string").alias("explicit_label"))
    if course is not None:
        out.append(column(course).cast("string").alias("course_id"))
    return df.select(*out, *flag_columns(df, flags))


def union_reviews(tables: Sequence[DataFrame]) -> DataFrame:
    """Stack tables with different columns; a column a table lacks is null there."""
    if not tables:
        raise ValueError("no review tables")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
