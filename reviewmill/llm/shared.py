"""What several operators share: the given tables, words, hashes, numbering without a single task."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The white space of the word class [^\x20\x09-\x0D]+; Python's bytes.split() uses the same six bytes.
BLANK = "[\\x20\\x09-\\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def without_empty_ends(parts: Column) -> Column:
    """The pieces of a split by runs of separators, without the empty ones before and after them."""
    return F.filter(parts, lambda word: word != "")


def blank_words(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ of a text; none for null."""
    return without_empty_ends(F.split(F.coalesce(text, F.lit("")), BLANK))


def word_count(text: Column) -> Column:
    """Number of those words, from the separators only."""
    parts = F.split(F.coalesce(text, F.lit("")), BLANK)
    return (
        F.size(parts)
        - (F.element_at(parts, 1) == "").cast("int")
        - ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")
    ).cast("long")


def unit_draw(key: Column) -> Column:
    """A number strictly between 0 and 1 that the text ``key`` decides: 52 bits of its md5."""
    bits = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + 0.5) / float(1 << 52)


def id_text(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit("null"))


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a batch's texts; null as empty."""
    return [text or b"" for text in column.cast(pa.large_binary()).to_pylist()]


def sliced(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what a task keeps in memory at a time does not follow Spark's batch size."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def numbered(df: DataFrame, group: str, cell: str, order: list[str], name: str) -> DataFrame:
    """Adds ``name``: 0, 1, 2, ... without gaps within each ``group``, by cell, then by ``order``.

    ``cell`` is a small integer that deals the rows of a group out evenly, so no task sees a whole group:
    rows are numbered within (group, cell) and the cells' counts give the offsets.  The table of counts has
    one row per group and cell, whatever the number of rows.  ``df`` is read twice and must come out alike.
    Rows that agree in everything are numbered in any order.
    """
    counts = df.groupBy(group, cell).agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(group).orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(group).alias("_group"),
        F.col(cell).alias("_place"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
    )
    within = F.row_number().over(Window.partitionBy(group, cell).orderBy(*order)) - 1
    return (
        df.withColumn("_within", within)
        .join(offsets, F.col(group).eqNullSafe(F.col("_group")) & (F.col(cell) == F.col("_place")))
        .withColumn(name, (F.col("_within") + F.col("_before")).cast("long"))
        .drop("_within", "_before", "_group", "_place")
    )
