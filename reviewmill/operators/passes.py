"""Passes over stored training rows: numpy per batch inside the tasks, sums over the cluster.

A fit here is a loop on the driver whose state is a model of bounded size; each step is one Spark job that reads the
stored rows, adds up some statistics of the size of the model per task, and sums those over the tasks.  The statistics
travel in slices, so that no task and no message holds more than a slice of every task's sums at a time.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.session import materialise

#: Numbers per slice.
SLICE = 16_384
#: Numbers that all tasks together send to the driver without a shuffle (64 MB).
DIRECT = 8_000_000
#: Parts per core that a pass over stored rows has at most, if it is ``gathered``.
PARTS = 3
#: Rows that a task works on at a time.
ROWS = 2_000


def place_type(width: int) -> type:
    return np.uint16 if width <= 1 << 16 else np.uint32


def flat(column: pa.BinaryArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a column of bytes one after the other, and how many each row has."""
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    size, data = np.dtype(kind).itemsize, column.buffers()[2]
    if data is None or ends[-1] == ends[0]:
        return np.zeros(0, kind), np.zeros(len(column), dtype=np.int64)
    return np.frombuffer(data, kind, (ends[-1] - ends[0]) // size, int(ends[0])), np.diff(ends).astype(np.int64) // size


def as_bytes(numbers: np.ndarray, sizes: np.ndarray) -> pa.BinaryArray:
    """The reverse of :func:`flat`."""
    ends = np.concatenate([[0], np.cumsum(sizes)]) * numbers.itemsize
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(sizes), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(numbers.tobytes())]
    )


#: The largest count of an entry of packed rows; a larger one stands in several entries.
MOST = 255


def packed(row: np.ndarray, column: np.ndarray, count: np.ndarray, rows: int, width: int) -> tuple[pa.BinaryArray, pa.BinaryArray]:
    """Columns ``indices`` and ``values`` of packed rows, from the entries in order of rows and columns."""
    parts = -(-count // MOST)
    if len(parts) and parts.max() > 1:
        last = np.cumsum(parts) - 1
        row, column, rest = np.repeat(row, parts), np.repeat(column, parts), count - MOST * (parts - 1)
        count = np.full(len(row), MOST)
        count[last] = rest
    sizes = np.bincount(row, minlength=rows)
    return as_bytes(column.astype(place_type(width)), sizes), as_bytes(count.astype(np.uint8), sizes)


class Sparse:
    """Sparse rows: column and value of every entry.  They come as arrays, or packed, which a task reads in one piece: places
    and counts as bytes, and a ``length`` by which a row is divided; then ``scale`` has the value of a count per column."""

    def __init__(self, batch: pa.RecordBatch, scale: np.ndarray | None = None):
        indices, values = batch.column("indices"), batch.column("values")
        self.scale, self.share = scale, None
        if scale is not None:
            column, sizes = flat(indices, place_type(len(scale)))
            value = flat(values, np.uint8)[0]
            length = np.asarray(batch.column("length"), dtype=np.float64)
            self.share = 1 / np.where(length > 0, length, 1)
        else:
            sizes = np.asarray(indices.value_lengths().fill_null(0), dtype=np.int64)
            column, value = indices.flatten(), values.flatten()
        self.rows, self.sizes = len(sizes), sizes
        self.column = np.asarray(column, dtype=np.int64)
        self.value = np.asarray(value, dtype=np.float64)
        if scale is not None and (self.value == MOST).any():
            self._join()

    def _join(self) -> None:
        """One entry for a count that stands in several."""
        first = np.flatnonzero((np.diff(self.column, prepend=-1) != 0) | (np.diff(self.row, prepend=-1) != 0))
        self.value, self.sizes = np.add.reduceat(self.value, first), np.bincount(self.row[first], minlength=self.rows)
        self.column, self.row = self.column[first], self.row[first]

    @cached_property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.sizes)

    def times(self, weights: np.ndarray) -> np.ndarray:
        """Rows times a matrix (columns, models).  A row's entries stand together, so its sum is that of a run."""
        out = np.zeros((self.rows, weights.shape[1]))
        filled = np.flatnonzero(self.sizes)
        if len(filled):
            starts = (np.cumsum(self.sizes) - self.sizes)[filled]
            for m, model in enumerate(np.ascontiguousarray(weights.T)):
                each = model if self.scale is None else model * self.scale
                out[filled, m] = np.add.reduceat(self.value * each.take(self.column), starts)
        return out if self.share is None else out * self.share[:, None]

    def transposed_times(self, numbers: np.ndarray, width: int, power: int = 1) -> np.ndarray:
        """Columns (entries to a power) times a matrix (rows, models)."""
        value = self.value if power == 1 else self.value**power
        if self.share is not None:
            numbers = numbers * self.share[:, None] ** power
        each = [np.bincount(self.column, value * np.repeat(model, self.sizes), width) for model in np.ascontiguousarray(numbers.T)]
        found = np.stack(each, 1)
        return found if self.scale is None else found * self.scale[:, None] ** power


def as_rows(vectors: DataFrame, keep: Sequence[str] = (), features: str = "features") -> DataFrame:
    """indices, values and the columns to keep of a table with sparse vectors."""
    parts = F.unwrap_udt(features)
    return vectors.select(*keep, parts.getField("indices").alias("indices"), parts.getField("values").alias("values"))


def stored_rows(vectors: DataFrame, keep: Sequence[str] = (), features: str = "features") -> DataFrame:
    """The same, written once."""
    return materialise(as_rows(vectors, keep, features))


def sliced(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def numbers(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    """Columns of a batch as a matrix of doubles."""
    return np.stack([np.asarray(batch.column(name), dtype=np.float64) for name in names], 1)


def tasks_of(rows: DataFrame) -> int:
    """Tasks that a pass over stored rows has; asked once per fit."""
    return rows.rdd.getNumPartitions()


def gathered(rows: DataFrame) -> DataFrame:
    """The rows in a few parts per core, so that few sums of the model's size are sent."""
    return rows.coalesce(PARTS * rows.sparkSession.sparkContext.defaultParallelism)


def summed(rows: DataFrame, size: int, statistics: Callable[[pa.RecordBatch], np.ndarray], tasks: int | None = None) -> np.ndarray:
    """The sum of ``statistics``, ``size`` numbers per batch, over all rows.  With few ``tasks`` their sums go to the
    driver as they are, ``DIRECT`` numbers at most; otherwise they are summed by slices over the cluster first."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in sliced(batches):
            total += statistics(batch).ravel()
        for start in range(0, size, SLICE):
            part = pa.array([total[start : start + SLICE]], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array([start], pa.int64()), part], names=["start", "part"])

    parts = rows.mapInArrow(task, "start long, part array<double>")
    if tasks is None or tasks * size > DIRECT:
        parts = parts.groupBy("start").agg(vector_to_array(Summarizer.sum(array_to_vector("part"))).alias("part"))
    sums = parts.toArrow()
    out = np.zeros(size)
    for start, part in zip(sums["start"].to_pylist(), sums["part"].combine_chunks(), strict=True):
        found = np.asarray(part.values)
        out[start : start + len(found)] += found
    return out



# The functions travel with the tasks, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
