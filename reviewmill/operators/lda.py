"""Latent Dirichlet allocation by batch variational inference: every review counts once in every pass.

A pass is one job over the stored counts.  Tasks find each review's topic shares for the current topics and
sum the expected uses of every term by topic; the driver turns the sums into the next topics (``k`` rows of the
vocabulary's size, bounded).  The sums of a pass always add up to the number of tokens, and the evidence bound that
comes with them says how far the fit is.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from reviewmill.operators.passes import Sparse, sliced, summed, tasks_of

#: A review's shares are settled when its topic numbers move by less than this on average.
SETTLED = 1e-3
INNER = 100
TINY = 1e-100
#: Terms of all reviews that are worked on together.
CELLS = 16_384


def digamma(x: np.ndarray) -> np.ndarray:
    """Six steps of the recurrence, then the asymptotic series."""
    shift = sum(1 / (x + i) for i in range(6))
    y = x + 6
    z = 1 / (y * y)
    return np.log(y) - 0.5 / y - z * (1 / 12 - z * (1 / 120 - z * (1 / 252 - z * (1 / 240 - z / 132)))) - shift


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series six steps up."""
    shift = sum(np.log(x + i) for i in range(6))
    y = x + 6
    z = 1 / (y * y)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y - shift


def expected_log(parameters: np.ndarray) -> np.ndarray:
    """Expected logarithm of Dirichlet shares, by row."""
    return digamma(parameters) - digamma(parameters.sum(1, keepdims=True))


def topic_numbers(counts: Sparse, topics: np.ndarray, prior: float) -> np.ndarray:
    """Per review its Dirichlet parameters (rows, k) for the given term weights of the topics (terms, k).  Reviews of about
    the same length are worked on together, as many as stay in the processor's cache over the inner steps."""
    out = np.full((counts.rows, topics.shape[1]), prior)
    # Only reviews with terms have anything to find.
    live, first, sizes = np.unique(counts.row, return_index=True, return_counts=True)
    order = np.argsort(sizes, kind="stable")
    start = 0
    while start < len(order):
        # Padded to the longest, the last: the first of the following reviews with which the block would be too large.
        room = np.arange(1, len(order) - start + 1) * sizes[order[start:]] > CELLS
        end = start + (max(1, int(room.argmax())) if room.any() else len(room))
        block = order[start:end]
        column = np.arange(sizes[block[-1]])
        known = column < sizes[block][:, None]
        entry = np.where(known, first[block][:, None] + column, 0)
        out[live[block]] = settled(topics[counts.column[entry]], np.where(known, counts.value[entry], 0.0), prior)
        start = end
    return out


def settled(weight: np.ndarray, value: np.ndarray, prior: float) -> np.ndarray:
    """The parameters of some reviews from the topic weights (reviews, terms, k) and counts (reviews, terms; 0 where a
    review has no more terms); reviews that have settled leave."""
    out = np.ones((len(weight), weight.shape[2]))
    gamma, live, going = out.copy(), np.arange(len(weight)), np.ones(len(weight), dtype=bool)
    for _ in range(INNER):
        shares = np.exp(expected_log(gamma))
        norm = np.matmul(weight, shares[:, :, None])[:, :, 0] + TINY
        found = prior + shares * np.matmul((value / norm)[:, None, :], weight)[:, 0]
        out[live[going]] = found[going]
        # A settled review stays as it is, however long its neighbours move.
        going &= np.abs(found - gamma).mean(1) >= SETTLED
        gamma = found
        if not going.any():
            break
        if going.mean() < 0.7:
            weight, value, live, gamma, going = weight[going], value[going], live[going], gamma[going], going[going]
    return out


def statistics_of(counts: Sparse, topics: np.ndarray, prior: float) -> np.ndarray:
    """Expected uses of the terms by topic (terms x k numbers), then the reviews' part of the bound and their tokens."""
    width, k = topics.shape
    gamma = topic_numbers(counts, topics, prior)
    logs = expected_log(gamma)
    shares = np.exp(logs)
    norm = np.einsum("ek,ek->e", shares[counts.row], topics[counts.column]) + TINY
    part = counts.value / norm
    uses = [np.bincount(counts.column, shares[counts.row, topic] * part, width) * topics[:, topic] for topic in range(k)]
    bound = counts.value @ np.log(norm)
    bound += ((prior - gamma) * logs).sum() + log_gamma(gamma).sum() - counts.rows * k * log_gamma(np.array(prior))
    bound += counts.rows * log_gamma(np.array(k * prior)) - log_gamma(gamma.sum(1)).sum()
    return np.concatenate([np.stack(uses, 1).ravel(), [bound, counts.value.sum()]])


@dataclass(frozen=True)
class Lda:
    #: Dirichlet parameters of the topics, (k, terms).
    parameters: np.ndarray
    prior: float
    #: Per pass, with the topics it began with: evidence bound, sum of the expected uses, tokens.
    passes: list[tuple[float, float, float]]

    @property
    def weights(self) -> np.ndarray:
        return np.exp(expected_log(self.parameters)).T

    def top_terms(self, n: int) -> list[list[int]]:
        """Places of the heaviest terms of each topic, ties by place."""
        return [np.argsort(-row, kind="stable")[:n].tolist() for row in self.parameters]

    def assigned(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with indices and values) plus ``topicDistribution``; equal shares for a review without terms."""
        weights, prior = self.weights, self.prior
        kept = [c for c in rows.columns if c not in ("indices", "values")]
        schema = T.StructType([*[rows.schema[c] for c in kept], T.StructField("topicDistribution", T.ArrayType(T.DoubleType()))])

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in sliced(batches):
                gamma = topic_numbers(Sparse(batch), weights, prior)
                shares = pa.array(list(gamma / gamma.sum(1, keepdims=True)), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), shares], names=[*kept, "topicDistribution"])

        return rows.select(*kept, "indices", "values").mapInArrow(task, schema)


def topics_bound(parameters: np.ndarray, prior: float) -> float:
    """The topics' part of the bound."""
    k, width = parameters.shape
    logs = expected_log(parameters)
    found = ((prior - parameters) * logs).sum() + log_gamma(parameters).sum() - k * width * log_gamma(np.array(prior))
    return float(found + k * log_gamma(np.array(width * prior)) - log_gamma(parameters.sum(1)).sum())


def fit(rows: DataFrame, k: int, width: int, passes: int, seed: int) -> Lda:
    """``rows``: stored counts (``passes.stored_rows``) over ``width`` terms.  The priors are 1/k; the first topics are
    drawn from a gamma distribution around one, as is customary."""
    prior = 1.0 / k
    parameters = np.random.default_rng(seed).gamma(100.0, 0.01, (k, width))
    history, tasks = [], tasks_of(rows)
    for _ in range(passes):
        weights = np.exp(expected_log(parameters)).T

        def statistics(batch: pa.RecordBatch, weights: np.ndarray = weights) -> np.ndarray:
            return statistics_of(Sparse(batch), weights, prior)

        found = summed(rows.select("indices", "values"), width * k + 2, statistics, tasks)
        uses = found[:-2].reshape(width, k).T
        history.append((float(found[-2]) + topics_bound(parameters, prior), float(uses.sum()), float(found[-1])))
        parameters = prior + uses
    return Lda(parameters, prior, history)


# The functions travel with the tasks, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
