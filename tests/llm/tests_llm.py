"""Helpers that test modules import by name."""

from __future__ import annotations

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def texts(spark, *values):
    return frame(spark, [(i, text, "en", "a", 0) for i, text in enumerate(values)])
