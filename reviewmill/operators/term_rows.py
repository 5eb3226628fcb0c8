"""TF-IDF rows of texts for a known vocabulary, counted by numbers inside the tasks.

Tokens come from column expressions; the tasks number the words of a slice of reviews, look up the words and pairs of
words that the vocabulary holds, and count them by sorting (review, term) numbers.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill.functions.stopwords import ENGLISH
from reviewmill.functions.tokens import tokens
from reviewmill.operators.corpus_terms import numbered, slices
from reviewmill.operators.passes import packed, sliced

#: Tokens that a task looks up at a time (a longer review is a slice of its own).
TOKENS = 500_000


@dataclass(frozen=True)
class Known:
    """The vocabulary by words: the words of all its terms, the term that a word is (-1: none), and the pairs (place of the
    first word times the number of words plus place of the second, in order) with their terms."""

    words: pa.Array
    single: np.ndarray
    pairs: np.ndarray
    pair_terms: np.ndarray


def known_terms(terms: Sequence[str]) -> Known:
    parts = [term.split(" ") for term in terms]
    place = {word: i for i, word in enumerate(dict.fromkeys(word for part in parts for word in part))}
    single = np.full(len(place), -1, dtype=np.int64)
    pairs = []
    for term, part in enumerate(parts):
        if len(part) == 1:
            single[place[part[0]]] = term
        else:
            pairs.append((place[part[0]] * len(place) + place[part[1]], term))
    found = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
    return Known(pa.array(list(place), pa.string()), single, found[:, 0].copy(), found[:, 1].copy())


def term_counts(words: pa.ListArray, known: Known, width: int, stop: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the review, term and occurrences, in order."""
    distinct, code, review = numbered(words, stop)
    place = np.asarray(pc.index_in(distinct, known.words.cast(distinct.type)).fill_null(-1), dtype=np.int64)
    word = place[code]
    known_word = np.flatnonzero(word >= 0)
    term = known.single[word[known_word]]
    found = [review[known_word[term >= 0]] * width + term[term >= 0]]
    if len(known.pairs):
        # Stop words are gone, words that no term holds are not: they part their neighbours.
        pair = np.flatnonzero((review[1:] == review[:-1]) & (word[1:] >= 0) & (word[:-1] >= 0))
        key = word[pair] * len(known.single) + word[pair + 1]
        at = np.minimum(np.searchsorted(known.pairs, key), len(known.pairs) - 1)
        hit = known.pairs[at] == key
        found.append(review[pair[hit]] * width + known.pair_terms[at[hit]])
    both = np.sort(np.concatenate(found))
    first = np.flatnonzero(np.diff(both, prepend=-1))
    return both[first] // width, both[first] % width, np.diff(first, append=len(both))


def term_rows(
    df: DataFrame,
    keep: Sequence[str],
    terms: Sequence[str],
    idf: Sequence[float],
    text: str = "clean_text",
    stop_words: list[str] | None = None,
    accents: bool = True,
) -> DataFrame:
    """``keep`` and packed rows (see ``passes.Sparse``, ``scale`` is ``idf``): tf x idf scaled to length one."""
    known, scale, width = known_terms(terms), np.array(idf), len(terms)
    stop = ENGLISH if stop_words is None else stop_words
    kept = [F.col(f"`{c}`") for c in keep]
    entries = [T.StructField(c, kind) for c, kind in (("indices", T.BinaryType()), ("values", T.BinaryType()), ("length", T.DoubleType()))]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = 0
            for words in slices(batch.column(len(keep)), TOKENS):
                review, term, count = term_counts(words, known, width, stop)
                length = np.sqrt(np.bincount(review, (count * scale[term]) ** 2, len(words)))
                found = [*packed(review, term, count, len(words), width), pa.array(length)]
                rows = batch.slice(start, len(words))
                start += len(words)
                out = pa.RecordBatch.from_arrays([*rows.columns[:-1], *found], names=[*keep, "indices", "values", "length"])
                yield from sliced([out])

    table = df.select(*kept, tokens(F.col(text), accents).alias("_words"))
    return table.mapInArrow(task, T.StructType([*table.schema[:-1], *entries]))


# The functions travel with the tasks, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
