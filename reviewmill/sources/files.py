"""Delimited scans and table sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.sources.ranges import read_in_ranges

# --- fixed values: cell contents that mean "no value" ---------------------------------------
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def separator(path: str) -> str:
    return "\t" if path.lower().endswith(".tsv") else ","


def read_delimited(spark: SparkSession, path: str, row_id: str = "source_row_id", in_ranges: bool = False) -> DataFrame:
    """A CSV or TSV file, or a folder of them, with a header and quoted multi-line text; every column a string, plus
    a row number: 0, 1, 2, ... in a single file, ascending and unique (not gapless) over a folder.

    One task reads each file, and a stray quote inside a field is taken as it stands.  ``in_ranges`` reads large files
    by many tasks and numbers rows without gaps over a folder; quotes must then follow the usual rule.
    """
    if in_ranges:
        raw = read_in_ranges(spark, path, separator(path), row_id)
    else:
        raw = spark.read.csv(
            path, sep=separator(path), header=True, multiLine=True, quote='"', escape='"', enforceSchema=False
        ).withColumn(row_id, F.monotonically_increasing_id())
    cells = [c for c in raw.columns if c != row_id]
    return raw.select(*[F.when(~F.col(f"`{c}`").isin(*NULL_TOKENS), F.col(f"`{c}`")).alias(c) for c in cells], row_id)


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), file_format: str = "parquet"
) -> None:
    """Replace the table at ``path``; CSV quotes and escapes so that it reads back unchanged."""
    writer = df.write.mode("overwrite").format(file_format)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if file_format == "csv":
        writer = writer.option("header", "true").option("escape", '"').option("quoteAll", "true")
    writer.save(path)


def read_table(spark: SparkSession, path: str, like: DataFrame, file_format: str = "parquet") -> DataFrame:
    """What :func:`write_table` has written of ``like``."""
    reader = spark.read.schema(like.schema).format(file_format)
    if file_format == "csv":
        reader = reader.option("header", "true").option("escape", '"').option("multiLine", "true")
    return reader.load(path)


def listed_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path) of every file below ``folder``; only the listing is used, no content is read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    )
