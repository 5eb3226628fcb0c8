"""Sentiment labels as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewmill import settings
from reviewmill.functions.text import SPACE


def _lookup(key: Column, table: dict[str, str]) -> Column:
    pairs = [F.lit(part) for pair in table.items() for part in pair]
    return F.element_at(F.create_map(*pairs), key)


def label_5class(column: Column, short_spellings: bool = False) -> Column:
    """1..5 or a class name (any case, padded, with a trailing ``.0``) to the class name; else null."""
    table = dict(settings.FIVE_CLASS_BY_KEY)
    if short_spellings:
        table.update(settings.SHORT_SPELLINGS)
    trimmed = F.regexp_replace(column.cast("string"), rf"(?U)\A[{SPACE}]+|[{SPACE}]+\z", "")
    return _lookup(F.lower(F.regexp_replace(trimmed, r"\.0\z", "")), table)


def label_3class(column: Column, short_spellings: bool = False) -> Column:
    return three_from_five(label_5class(column, short_spellings))


def three_from_five(five_class: Column) -> Column:
    return _lookup(five_class, settings.THREE_CLASS_BY_FIVE)


def sentiment_from_rating(rating: Column) -> Column:
    """4 and up positive, exactly 3 neutral, 2 and below negative; values in between have no label."""
    return (
        F.when(rating >= 4, "positive")
        .when(rating == 3, "neutral")
        .when(rating <= 2, "negative")
    )
