"""Terms of a whole table with their occurrences and reviews.

Tokens come from column expressions; the tasks number the words of a slice of reviews, sort (term, review) numbers and
count the runs, so only distinct terms of a slice are spelled out, with their counts, and summed over the cluster.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.functions.stopwords import ENGLISH
from reviewmill.functions.tokens import tokens

#: Tokens that a task counts at a time (a longer review is a slice of its own), and rows that it hands on at a time.
TOKENS = 2_000_000
HANDED = 100_000


def slices(words: pa.ListArray, most: int) -> Iterator[pa.ListArray]:
    """Reviews in a row with ``most`` tokens together."""
    ends = np.cumsum(np.asarray(words.value_lengths().fill_null(0), dtype=np.int64))
    start, before = 0, 0
    while start < len(ends):
        end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield words.slice(start, end - start)
        start, before = end, ends[end - 1]


def numbered(words: pa.ListArray, stop: Sequence[str]) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """The distinct words of some reviews; the number of every word that is no stop word, and its review's place."""
    found = pc.list_flatten(words).dictionary_encode()
    review = np.repeat(np.arange(len(words)), np.asarray(words.value_lengths().fill_null(0), dtype=np.int64))
    code = np.asarray(found.indices, dtype=np.int64)
    if stop:
        kept = ~np.asarray(pc.is_in(found.dictionary, pa.array(stop, found.dictionary.type)))[code]
        code, review = code[kept], review[kept]
    return found.dictionary, code, review


def runs(numbers: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of term << bits | review: the distinct terms, their occurrences and their reviews."""
    numbers = np.sort(numbers)
    terms = numbers >> bits
    first = np.flatnonzero(np.diff(terms, prepend=-1))
    if not len(first):
        return terms, first, first
    other = np.diff(numbers, prepend=-1) != 0
    return terms[first], np.diff(first, append=len(terms)), np.add.reduceat(other.astype(np.int64), first)


def counted(words: pa.ListArray, ngrams: tuple[int, int], stop: Sequence[str]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Terms of some reviews with occurrences and reviews, first the words, then the pairs."""
    known, code, review = numbered(words, stop)
    bits, width = max(1, (len(words) - 1).bit_length()), max(1, (len(known) - 1).bit_length())
    if bits + 2 * width > 63 and len(words) > 1:
        half = len(words) // 2
        yield from counted(words.slice(0, half), ngrams, stop)
        yield from counted(words.slice(half), ngrams, stop)
        return
    if ngrams[0] == 1:
        term, cf, df = runs(code << bits | review, bits)
        yield known.take(pa.array(term)), cf, df
    if ngrams[1] == 2:
        pair = np.flatnonzero(review[1:] == review[:-1])
        term, cf, df = runs((code[pair] << width | code[pair + 1]) << bits | review[pair], bits)
        first, second = known.take(pa.array(term >> width)), known.take(pa.array(term & ((1 << width) - 1)))
        yield pc.binary_join_element_wise(first, second, " "), cf, df


def corpus_terms(
    df: DataFrame,
    text: str = "clean_text",
    ngrams: tuple[int, int] = (1, 2),
    stop_words: list[str] | None = None,
    accents: bool = True,
) -> DataFrame:
    """(term, cf, df) of all reviews, each read once; one shuffle of the distinct terms of each slice."""
    if ngrams not in ((1, 1), (1, 2), (2, 2)):
        raise ValueError(f"unsupported n-gram range {ngrams}")
    stop = ENGLISH if stop_words is None else stop_words

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in slices(batch.column(0), TOKENS):
                for term, cf, reviews in counted(words, ngrams, stop):
                    out = pa.RecordBatch.from_arrays([term, pa.array(cf), pa.array(reviews)], names=["term", "cf", "df"])
                    yield from (out.slice(i, HANDED) for i in range(0, out.num_rows, HANDED))

    parts = df.select(tokens(F.col(text), accents).alias("words")).mapInArrow(task, "term string, cf long, df long")
    # Slices have few terms in common, so summing them before the shuffle as well would cost more than it saves.
    return parts.repartition("term").groupBy("term").agg(F.sum("cf").alias("cf"), F.sum("df").alias("df"))


# The functions travel with the tasks, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
