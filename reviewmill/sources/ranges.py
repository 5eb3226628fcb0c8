"""One large quoted CSV or TSV file read by many tasks, line breaks in quotes included.

Spark's text source cuts a file into byte ranges and gives each line to one of them.  Whether a line begins inside
quotes depends on all quotes before it, but a range can be summed up without knowing that: the parity of
its quotes, and how many records it would start in either case.  Running sums of those over the ranges tell every range
its state and the number of its first record, and a second pass cuts the lines into records.  Only records that
cross a border, one per border at most, are put together with a shuffle.
"""

from __future__ import annotations

import csv
import sys
from collections.abc import Iterator, Sequence
from itertools import groupby

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUMS = "file string, at long, odd boolean, outside long, inside long, header string"
PIECES = "number long, at long, whole boolean, text string"


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """file, at (where the range begins), line: in file order within each range."""
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), F.col("value").alias("line")
    )


def ranges_in(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[str]]]:
    """The ranges of a task one after the other, each with its lines."""

    def rows():
        for batch in batches:
            yield from zip(batch.column("file").to_pylist(), batch.column("at").to_pylist(), batch.column("line").to_pylist(), strict=True)

    for key, found in groupby(rows(), key=lambda row: row[:2]):
        yield key, (line for _, _, line in found)


def is_blank(line: str) -> bool:
    return line in ("", "\r")


SUMMED = pa.schema(
    [("file", pa.string()), ("at", pa.int64()), ("odd", pa.bool_()), ("outside", pa.int64()), ("inside", pa.int64()), ("header", pa.string())]
)
CUT = pa.schema([("number", pa.int64()), ("at", pa.int64()), ("whole", pa.bool_()), ("text", pa.string())])
ROWS = 5000


def is_odd(text: str) -> bool:
    return text.count('"') % 2 == 1


def summed_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range: whether its quotes are odd, the records it starts if it begins outside or inside quotes, and, at the
    start of a file, the first record."""
    for (file, at), lines in ranges_in(batches):
        odd, starts, header = False, [0, 0], []
        for line in lines:
            if at == 0 and (is_odd("".join(header)) if header else not is_blank(line) and starts[0] == 0):
                header.append(line)
            # A blank line is no record, but inside quotes it is part of one.
            starts[odd] += not is_blank(line)
            odd ^= is_odd(line)
        row = [[file], [at], [odd], [starts[0]], [starts[1]], ["\n".join(header) if header else None]]
        yield pa.RecordBatch.from_arrays([pa.array(value, kind.type) for value, kind in zip(row, SUMMED, strict=True)], schema=SUMMED)


def starting_states(ranges: Sequence) -> dict[tuple[str, int], tuple[bool, int, int, int]]:
    """Per range: whether it begins inside quotes; the records of its file before it, header included; the
    number of the file's first record over all files, headers left out; the number of the file's header, below zero."""
    states, base = {}, 0
    for i, (_, each) in enumerate(groupby(sorted(ranges, key=lambda r: (r.file, r.at)), key=lambda r: r.file)):
        inside, before = False, 0
        for r in each:
            states[r.file, r.at] = (inside, before, base, -1 - i)
            before += r.inside if inside else r.outside
            inside ^= r.odd
        base += max(0, before - 1)
    return states


def records(lines: DataFrame, states: dict[tuple[str, int], tuple[bool, int, int, int]]) -> DataFrame:
    """number, text: the records; headers have numbers below zero."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, bool, str]] = []

        def filled() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays([pa.array(c, kind.type) for c, kind in zip(zip(*out), CUT, strict=True)], schema=CUT)
            out.clear()
            return found

        for (file, at), lines in ranges_in(batches):
            inside, before, base, header = states[file, at]
            # What comes before the first record of the range belongs to the one before.
            place, held, begun = before - 1, [], False
            for line in lines:
                if not inside:
                    if is_blank(line):
                        continue
                    place, begun = place + 1, True
                held.append(line)
                inside ^= is_odd(line)
                if not inside:
                    out.append((base + place - 1 if place else header, at, begun, "\n".join(held)))
                    held = []
                if len(out) >= ROWS:
                    yield filled()
            if held:
                out.append((base + place - 1 if place else header, at, False, "\n".join(held)))
        if out:
            yield filled()

    pieces = lines.mapInArrow(cut, PIECES)
    parts = F.sort_array(F.collect_list(F.struct("at", "text")))
    crossing = pieces.filter("not whole").groupBy("number").agg(F.array_join(F.transform(parts, lambda p: p.text), "\n").alias("text"))
    whole = pieces.filter("whole").select("number", "text").unionByName(crossing)
    return whole.withColumn("text", F.regexp_replace("text", "\r$", ""))


def read_in_ranges(spark: SparkSession, path: str, separator: str, row_id: str) -> DataFrame:
    """Columns as strings and ``row_id``: 0, 1, 2, ... without gaps over all files, by file and place.

    Quotes follow the usual rule: a field with quotes, separators or line breaks is quoted, and quotes inside are
    doubled.  Every file begins with the same header.  The driver holds a few numbers per range, as Spark itself does.
    """
    lines = lines_of(spark, path)
    ranges = lines.mapInArrow(summed_up, SUMS).collect()
    headers = sorted({r.header.removeprefix("﻿").removesuffix("\r") for r in ranges if r.header is not None})
    if len(headers) != 1 or is_odd(headers[0]):
        raise ValueError(f"{path}: expected one header, found {headers}")
    columns = next(csv.reader([headers[0]], delimiter=separator))
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in columns)
    options = {"sep": separator, "quote": '"', "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"}
    parsed = F.from_csv("text", schema, options).alias("row")
    return records(lines, starting_states(ranges)).filter("number >= 0").select(parsed, "number").select("row.*", F.col("number").alias(row_id))


# The functions travel with the tasks, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
