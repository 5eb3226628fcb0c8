"""Large delimited files read by byte ranges."""

from __future__ import annotations

import csv
import random

import pytest

from reviewmill.sources import ranges
from reviewmill.sources.files import read_delimited


def written(path, rows, ending="\n", delimiter=",", header=("id", "the text", "more")):
    with open(path, "w", newline="", encoding="utf-8") as handle:
        writer = csv.writer(handle, delimiter=delimiter, lineterminator=ending)
        writer.writerow(header)
        writer.writerows(rows)


@pytest.fixture(scope="module")
def rows():
    """Line breaks, quotes, separators and blank lines inside quotes, so that any border can fall into a record."""
    draw = random.Random(7)
    parts = ["word", "\n", "\n\n", '"', '""', ",", "é😀", " ", "\t", "'", '\n"\n']
    return [[str(i), "x" + "".join(draw.choice(parts) for _ in range(draw.randrange(12))), draw.choice(["", "a", 'b"c', "d\ne"])] for i in range(400)]


@pytest.fixture
def split(spark):
    """As many ranges as asked for, whatever the size of the file."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    old = [spark.conf.get(name, None) for name in names]

    def into(size, n):
        spark.conf.set(names[0], str(-(-size // n)))
        spark.conf.set(names[1], "0")
        spark.conf.set(names[2], str(n))

    yield into
    for name, value in zip(names, old):
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def read(spark, path):
    found = read_delimited(spark, str(path), "n", in_ranges=True).orderBy("n").collect()
    assert [r.n for r in found] == list(range(len(found)))
    return [[r["id"], r["the text"], r["more"] or ""] for r in found]


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_the_same_with_any_number_of_ranges(spark, tmp_path, rows, split, ending):
    path = tmp_path / "reviews.csv"
    written(path, rows, ending)
    size = path.stat().st_size
    for n in (1, 2, 16, 200):
        split(size, n)
        found = ranges.lines_of(spark, str(path)).select("at").distinct().count()
        assert found == 1 if n == 1 else found > n / 4
        assert read(spark, path) == rows
    whole = read_delimited(spark, str(path), "n").collect()
    assert [[r["id"], r["the text"], r["more"] or ""] for r in whole] == rows


def test_every_border(spark, tmp_path, split):
    """One record with every kind of place, and a border after each byte from the second line on."""
    path = tmp_path / "few.csv"
    rows = [["1", 'a\n"b"\n\nc', "x"], ["2", "plain", ""], ["3", "\n", "é\n"]]
    written(path, rows)
    size = path.stat().st_size
    split(size, 1)
    for width in range(18, size + 1, 3):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(width))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        lines = ranges.lines_of(spark, str(path)).collect()
        order = sorted({(r.file, r.at) for r in lines})
        text = "\n".join(line for key in order for line in (r.line for r in lines if (r.file, r.at) == key))
        assert text + "\n" == path.read_text(encoding="utf-8")
    for width in (18, 19, 23, 29, 37):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(width))
        assert read(spark, path) == rows


def test_a_folder_and_other_separators(spark, tmp_path, rows, split):
    folder = tmp_path / "many.tsv"
    folder.mkdir()
    for i in range(3):
        written(folder / f"part-{i}", rows[100 * i : 100 * i + 100], delimiter="\t")
    split(sum(p.stat().st_size for p in folder.iterdir()), 9)
    assert read(spark, folder) == rows[:300]


def test_headers(spark, tmp_path):
    path = tmp_path / "only.csv"
    path.write_text("﻿\n\nid,the text,more\n", encoding="utf-8")
    assert read(spark, path) == []
    folder = tmp_path / "two.csv"
    folder.mkdir()
    written(folder / "a", [["1", "x", "y"]])
    written(folder / "b", [["1", "x", "y"]], header=("id", "other", "more"))
    with pytest.raises(ValueError):
        read_delimited(spark, str(folder), in_ranges=True)
