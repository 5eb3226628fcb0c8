"""Benchmark decontamination by latent semantic retrieval.

1. Each text becomes the numbers of its words in the benchmark's vocabulary (0 for any other word), stored once.
2. TF-IDF over passages of ``PASSAGE`` words, without the words in more than ``COMMON`` passages (an item
   keeps its ``RAREST`` rarest words in any case).
3. A randomised SVD of the passages and the benchmark items: with A the TF-IDF rows, every task sums its share of
   A'(A R) for a random matrix R; the driver adds one matrix of vocabulary by ``RANK`` and takes its basis.
4. Windows of the texts, overlapping so that each item's length fits into one, are compared with the items by cosine
   in that basis.  Sums along the text give a window's vector as a difference.
5. Candidates are confirmed by the longest common subsequence of words, and by the share of the item's answer (its
   last sentence if there is no answer column) that the window holds.

The benchmark is taken in blocks of ``BLOCK`` items, so what every task holds is bounded.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.shared import sliced
from reviewmill.session import materialise

PASSAGE = 64
# A word is common in more passages than this number and this share of all.
COMMON = (50, 0.01)
RAREST = 8
RANK = 96
BLOCK = 20_000
COSINE = 0.5
SUBSEQUENCE = 0.6
ANSWER = 0.5
SEED = 20

SEPARATE = bytes.maketrans(bytes(range(128)), bytes(c if chr(c).isalnum() else 32 for c in range(128)))


def words_of(text: str) -> list[bytes]:
    """Lower-cased runs of letters and digits; everything beyond ASCII belongs to words."""
    return text.lower().encode().translate(SEPARATE).split()


@dataclass
class Benchmark:
    """Items of one block: ids, word numbers, answers as sets of word numbers; the vocabulary from 1."""

    ids: list
    items: list[np.ndarray]
    answers: list[np.ndarray]
    vocabulary: dict[bytes, int]

    @staticmethod
    def of(rows: list) -> Benchmark:
        vocabulary: dict[bytes, int] = {}
        ids, items, answers = [], [], []
        for row in rows:
            words = words_of(row.text or "")
            if not words:
                continue
            numbers = np.array([vocabulary.setdefault(word, len(vocabulary) + 1) for word in words])
            sentences = [part for part in re.split(r"[.!?\n]+", row.text) if words_of(part)]
            answer = getattr(row, "answer", None) or sentences[-1]
            known = {vocabulary.setdefault(word, len(vocabulary) + 1) for word in words_of(answer)}
            ids.append(row.item_id)
            items.append(numbers)
            answers.append(np.array(sorted(known or set(numbers.tolist()))))
        return Benchmark(ids, items, answers, vocabulary)

    @property
    def dtype(self):
        return np.uint16 if len(self.vocabulary) < 1 << 16 else np.uint32

    def numbers(self, text: str) -> np.ndarray:
        get = self.vocabulary.get
        return np.array([get(word, 0) for word in words_of(text)], self.dtype)


def numbered_texts(docs: DataFrame, benchmark: Benchmark) -> DataFrame:
    """doc_id, numbers (the words' numbers, packed)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 500):
            packed = [benchmark.numbers(text or "").tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(packed, pa.binary())], names=["doc_id", "numbers"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, "doc_id bigint, numbers binary")


def passages(batch: pa.RecordBatch, dtype) -> tuple[np.ndarray, np.ndarray, int]:
    """Word numbers of a batch that are in the vocabulary, the passage of each, and the number of passages."""
    texts = [np.frombuffer(numbers, dtype) for numbers in batch.column("numbers").to_pylist()]
    sizes = np.array([len(text) for text in texts])
    counts = -(-sizes // PASSAGE)
    if not sizes.sum():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    first = np.repeat(np.cumsum(counts) - counts, sizes)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    words = np.concatenate(texts)
    held = words > 0
    return words[held].astype(np.int64), (first + within // PASSAGE)[held], int(counts.sum())


def few_tasks(df: DataFrame) -> DataFrame:
    """No more tasks than run in a few waves: each returns a matrix, however much it has read."""
    return df.coalesce(4 * df.sparkSession.sparkContext.defaultParallelism)


def document_frequencies(numbered: DataFrame, benchmark: Benchmark) -> tuple[np.ndarray, int]:
    """Passages with each word, and the number of passages (under word 0)."""
    size, dtype = len(benchmark.vocabulary) + 1, benchmark.dtype

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in sliced(batches, 500):
            words, passage, n = passages(batch, dtype)
            total += np.bincount(np.unique(passage * size + words) % size, minlength=size)
            total[0] += n
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["word", "passages"])

    counts = np.zeros(size, np.int64)
    rows = few_tasks(numbered).mapInArrow(counted, "word bigint, passages bigint")
    for row in rows.groupBy("word").agg(F.sum("passages").alias("passages")).collect():  # a row per vocabulary word
        counts[row.word] = row.passages
    return counts, int(counts[0])


def term_weights(benchmark: Benchmark, counts: np.ndarray, total: int) -> np.ndarray:
    """Inverse document frequencies; 0 for words outside the vocabulary of the TF-IDF."""
    weights = np.log((1 + total) / (1 + counts)) + 1
    common = counts > COMMON[0] + COMMON[1] * total
    for item in benchmark.items:
        rarest = sorted(set(item.tolist()), key=lambda word: (counts[word], word))[:RAREST]
        common[rarest] = False
    weights[common] = 0
    weights[0] = 0
    return weights


def product(words: np.ndarray, passage: np.ndarray, weights: np.ndarray, right: np.ndarray, into: np.ndarray) -> None:
    """Adds A'(A right) of these TF-IDF rows to ``into``; the rows' entries come in order of passage."""
    held = weights[words] > 0
    words, passage = words[held], passage[held]
    if not len(words):
        return
    weight = weights[words][:, None].astype(np.float32)
    starts = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
    rows = np.add.reduceat(right[words] * weight, starts, axis=0)
    spread = rows[np.cumsum(np.r_[False, passage[1:] != passage[:-1]])] * weight
    order = np.argsort(words, kind="stable")
    ordered = words[order]
    firsts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
    into[ordered[firsts]] += np.add.reduceat(spread[order], firsts, axis=0)


def latent_basis(numbered: DataFrame, benchmark: Benchmark, weights: np.ndarray, total: int) -> np.ndarray:
    """Vocabulary by rank: an orthonormal basis of the leading right singular vectors."""
    size, dtype = len(benchmark.vocabulary) + 1, benchmark.dtype
    rank = min(RANK, size)
    right = np.random.default_rng(SEED).standard_normal((size, rank)).astype(np.float32)

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((size, rank), np.float64)
        for batch in sliced(batches, 200):
            words, passage, _ = passages(batch, dtype)
            product(words, passage, weights, right, sums)
        found = np.flatnonzero(np.abs(sums).sum(axis=1))
        for start in range(0, len(found), 2000):
            part = found[start : start + 2000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(list(sums[part]), pa.list_(pa.float64()))], names=["word", "sums"]
            )

    partial = few_tasks(numbered).mapInArrow(multiplied, "word bigint, sums array<double>")
    totals = partial.groupBy("word").agg(*[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(rank)])
    matrix = np.zeros((size, rank))
    for row in totals.collect():  # a row per vocabulary word
        matrix[row[0]] = row[1:]
    # The items are rows too; together they weigh as much as the passages, so their words are represented.
    own = np.zeros((size, rank))
    words = np.concatenate(benchmark.items)
    product(words, np.repeat(np.arange(len(benchmark.items)), [len(item) for item in benchmark.items]), weights, right, own)
    scale = np.linalg.norm(matrix) / (np.linalg.norm(own) or 1.0)
    left, values, _ = np.linalg.svd(matrix + own * (scale or 1.0), full_matrices=False)
    return np.ascontiguousarray(left[:, values > 1e-9 * max(values[0], 1e-300)], np.float32)


def common_subsequence(item: np.ndarray, window: np.ndarray) -> int:
    """Length of the longest common subsequence, with one bit per word of the item."""
    places: dict[int, int] = {}
    for i, word in enumerate(item.tolist()):
        places[word] = places.get(word, 0) | 1 << i
    row = full = (1 << len(item)) - 1
    for word in window.tolist():
        here = row & places.get(word, 0)
        if here:
            row = ((row + here) | (row - here)) & full
    return len(item) - row.bit_count()


class Search:
    """Everything a task needs to find the items of a block in a text."""

    def __init__(self, benchmark: Benchmark, weights: np.ndarray, basis: np.ndarray):
        self.benchmark = benchmark
        self.weights = weights
        self.vectors = basis * weights[:, None].astype(np.float32)
        latent = np.array([self.vectors[item].sum(axis=0) for item in benchmark.items])
        norms = np.linalg.norm(latent, axis=1, keepdims=True)
        self.latent = latent / np.where(norms > 0, norms, 1)
        # Items by length, doubling: (longest, items); windows are half as long again and half that apart.
        classes: dict[int, list[int]] = {}
        for i, item in enumerate(benchmark.items):
            classes.setdefault(max(16, 1 << (len(item) - 1).bit_length()), []).append(i)
        self.classes = [(longest, np.array(each)) for longest, each in sorted(classes.items())]

    def found(self, numbers: np.ndarray) -> list[tuple[int, float, float, float, int]]:
        """(item, cosine, share of the item in the common subsequence, share of the answer, first word) of the
        best window for each item that is in the text."""
        numbers = numbers.astype(np.int64)
        at = np.flatnonzero(self.weights[numbers] > 0)
        if not len(at):
            return []
        sums = np.zeros((len(at) + 1, self.vectors.shape[1]), np.float32)
        np.cumsum(self.vectors[numbers[at]], axis=0, out=sums[1:], dtype=np.float32)
        best: dict[int, tuple] = {}
        for longest, items in self.classes:
            step = longest // 2
            starts = np.arange(0, max(1, len(numbers) - step), step)
            low, high = np.searchsorted(at, starts), np.searchsorted(at, starts + 3 * step)
            use = high > low
            starts, low, high = starts[use], low[use], high[use]
            if not len(starts):
                continue
            windows = sums[high] - sums[low]
            norms = np.linalg.norm(windows, axis=1, keepdims=True)
            cosines = (windows / np.where(norms > 0, norms, 1)) @ self.latent[items].T
            for window, item in np.argwhere(cosines >= COSINE).tolist():
                number, start = int(items[item]), int(starts[window])
                words, target = numbers[start : start + 3 * step], self.benchmark.items[number]
                share = common_subsequence(target, words) / len(target)
                if share < SUBSEQUENCE:
                    continue
                answer = self.benchmark.answers[number]
                held = float(np.isin(answer, words).mean())
                if held >= ANSWER and (number not in best or share > best[number][2]):
                    best[number] = (number, float(cosines[window, item]), share, held, start)
        return [best[number] for number in sorted(best)]


def blocks(benchmark: DataFrame) -> Iterator[Benchmark]:
    columns = [F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")]
    items = benchmark.select(*columns, *(["answer"] if "answer" in benchmark.columns else []))
    n = -(-items.count() // BLOCK)
    for i in range(n):
        block = Benchmark.of(items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).orderBy("item_id", "text").collect())
        if block.items:
            yield block


def prepared(numbered: DataFrame, block: Benchmark) -> Search:
    counts, total = document_frequencies(numbered, block)
    weights = term_weights(block, counts, total)
    return Search(block, weights, latent_basis(numbered, block, weights, total))


SCHEMA = "doc_id bigint, item_id bigint, cosine double, subsequence double, answer double, first_word bigint"


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs`` and benchmark item found in it: doc_id, item_id, cosine, subsequence and answer
    (shares of the item and of its answer), first_word of the window.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text and may have answer; other columns are ignored.
    Null and empty texts and items match nothing.  Equal items are found each; repeated rows each for itself.
    """
    result = docs.sparkSession.createDataFrame([], SCHEMA)
    for block in blocks(benchmark):
        numbered = materialise(numbered_texts(docs, block))
        search = prepared(numbered, block)

        def searched(batches: Iterator[pa.RecordBatch], search: Search = search) -> Iterator[pa.RecordBatch]:
            for batch in sliced(batches, 500):
                ids, rows = batch.column("doc_id").to_pylist(), []
                for doc_id, numbers in zip(ids, batch.column("numbers").to_pylist(), strict=True):
                    for item, *rest in search.found(np.frombuffer(numbers, search.benchmark.dtype)):
                        rows.append((doc_id, search.benchmark.ids[item], *rest))
                columns = list(zip(*rows, strict=True)) or [()] * 6
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)],
                    names=["doc_id", "item_id", "cosine", "subsequence", "answer", "first_word"],
                )

        result = result.unionByName(numbered.mapInArrow(searched, SCHEMA))
    return result


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item is found, with all their columns; no text is shuffled."""
    result = docs
    for block in blocks(benchmark):
        search = prepared(materialise(numbered_texts(docs, block)), block)

        def clean(batches: Iterator[pa.RecordBatch], search: Search = search) -> Iterator[pa.RecordBatch]:
            for batch in sliced(batches, 500):
                texts = batch.column("text").to_pylist()
                yield batch.filter(pa.array([not search.found(search.benchmark.numbers(text or "")) for text in texts], pa.bool_()))

        result = result.mapInArrow(clean, docs.schema)
    return result
