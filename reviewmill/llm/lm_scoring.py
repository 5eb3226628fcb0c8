"""Masked pseudo-likelihood: a small bidirectional window network scores documents.

1. Words are counted over the whole corpus; the ``TOP`` most frequent ones are tokens, all others share ``ENDINGS``
   tokens by their last letters.  Every text is stored once as a row of tokens and the words behind shared tokens.
2. The network predicts a masked word from ``SIDE`` words on either side: embeddings, one tanh layer, softmax over all
   tokens.  Each round, every task starts from the same weights, masks a share of the positions of all its texts and
   takes Adagrad steps in numpy; the average of the tasks' weights, by masked positions, starts the next round.
3. A document's score masks every position in turn and sums the log-probabilities of its words: that of the token by
   the network, and that of the word given its token by the corpus counts.  The table of all counted words is joined
   with the texts' words; it grows with the corpus and is never gathered in one place.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.shared import sliced
from reviewmill.session import materialise

TOP = 127
ENDINGS = 32
TOKENS = TOP + ENDINGS
PAD = TOKENS  # stands beyond the ends of a text; never predicted
SIDE = 2
OFFSETS = [d for d in range(-SIDE, SIDE + 1) if d]
EMBEDDING = 12
HIDDEN = 32
ROUNDS = 2
MASKED = 1 / 8
STEP_ROWS = 256
RATE = 0.1
SEED = 7
# Counts that a task keeps before it passes them on.
COUNTS_HELD = 200_000
SEPARATE = bytes.maketrans(bytes(range(128)), bytes(c if chr(c).isalnum() else 32 for c in range(128)))


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters and digits; everything beyond ASCII belongs to words."""
    return (text or "").lower().encode().translate(SEPARATE).split()


def word_counts(docs: DataFrame) -> DataFrame:
    """word, uses over all texts; summed within tasks before the shuffle."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uses: Counter = Counter()

        def passed_on() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays(
                [pa.array(list(uses), pa.binary()), pa.array(list(uses.values()), pa.int64())], names=["word", "uses"]
            )
            uses.clear()
            return rows

        for batch in sliced(batches, 500):
            for text in batch.column("text").to_pylist():
                uses.update(words_of(text))
            if len(uses) > COUNTS_HELD:
                yield passed_on()
        yield passed_on()

    return docs.select("text").mapInArrow(counted, "word binary, uses bigint").groupBy("word").agg(F.sum("uses").alias("uses"))


def tokens(words: list[bytes], numbers: dict[bytes, int]) -> np.ndarray:
    """Known words by number, others by the hash of their last two bytes; both bounded by the vocabulary."""
    endings: dict[bytes, int] = {}
    row = []
    for word in words:
        number = numbers.get(word)
        if number is None:
            ending = word[-2:]
            number = endings.get(ending)
            if number is None:
                number = endings[ending] = TOP + zlib.crc32(ending) % ENDINGS
        row.append(number)
    return np.array(row, np.uint8)


def encoded(docs: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """row (its number), doc_id, tokens (a byte each), rest: the words without a token of their own, blanks between."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 500):
            packed, rest = [], []
            for text in batch.column("text").to_pylist():
                words = words_of(text)
                packed.append(tokens(words, numbers).tobytes())
                rest.append(b" ".join([word for word in words if word not in numbers]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(packed, pa.binary()), pa.array(rest, pa.binary())],
                names=["row", "doc_id", "tokens", "rest"],
            )

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return numbered.mapInArrow(rows, "row bigint, doc_id bigint, tokens binary, rest binary")


def word_rows(stored: DataFrame) -> DataFrame:
    """word, rows, uses: where a word without a token of its own stands and how often; several rows per word."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 500):
            words = pc.split_pattern(batch.column("rest"), pattern=" ")
            own = np.repeat(np.arange(batch.num_rows), words.value_lengths())
            coded = words.flatten().dictionary_encode()
            pairs, uses = np.unique(coded.indices.to_numpy().astype(np.int64) * batch.num_rows + own, return_counts=True)
            firsts = np.searchsorted(pairs, np.arange(len(coded.dictionary) + 1) * batch.num_rows).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    coded.dictionary,
                    pa.ListArray.from_arrays(firsts, batch.column("row").take(pa.array(pairs % batch.num_rows))),
                    pa.ListArray.from_arrays(firsts, pa.array(uses.astype(np.int64))),
                ],
                names=["word", "rows", "uses"],
            )

    some = stored.select("row", "rest").filter(F.length("rest") > 0)
    return some.mapInArrow(listed, "word binary, rows array<bigint>, uses array<bigint>")


def within_tokens(stored: DataFrame, words: DataFrame) -> DataFrame:
    """row, within: the sum of ln p(word given its token) over the row's words; no row for texts without shared tokens."""
    places = word_rows(stored).join(words, "word").select("log_share", F.explode(F.arrays_zip("rows", "uses")).alias("at"))
    return places.groupBy(F.col("at.rows").alias("row")).agg(F.sum(F.col("at.uses") * F.col("log_share")).alias("within"))


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context tokens (a row per position, both sides), the token there, and the text it is in."""
    gap = np.full(SIDE, PAD, np.uint8)
    parts, sizes = [gap], []
    for text in texts:
        parts += [np.frombuffer(text, np.uint8), gap]
        sizes.append(len(text))
    line = np.concatenate(parts)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(sum(sizes)) + SIDE * (row + 1)
    return line[at[:, None] + np.array(OFFSETS)], line[at], row


@dataclass
class Network:
    embedding: np.ndarray  # tokens and PAD by EMBEDDING
    inner: np.ndarray  # context by HIDDEN
    inner_bias: np.ndarray
    outer: np.ndarray  # HIDDEN by tokens
    outer_bias: np.ndarray

    @staticmethod
    def first(shares: np.ndarray) -> Network:
        """Random weights; the output starts at the tokens' shares of the corpus."""
        draw = np.random.default_rng(SEED).standard_normal
        width = len(OFFSETS) * EMBEDDING
        return Network(
            (draw((TOKENS + 1, EMBEDDING)) * 0.3).astype(np.float32),
            (draw((width, HIDDEN)) / np.sqrt(width)).astype(np.float32),
            np.zeros(HIDDEN, np.float32),
            (draw((HIDDEN, TOKENS)) * 0.05).astype(np.float32),
            np.log(shares + 1e-6).astype(np.float32),
        )

    def parts(self) -> list[np.ndarray]:
        return [self.embedding, self.inner, self.inner_bias, self.outer, self.outer_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([part.ravel() for part in self.parts()]).astype(np.float64)

    def with_values(self, flat: np.ndarray) -> Network:
        cuts = np.cumsum([part.size for part in self.parts()])[:-1]
        new = [v.reshape(part.shape).astype(np.float32) for v, part in zip(np.split(flat, cuts), self.parts(), strict=True)]
        return Network(*new)

    def gradients(self, context: np.ndarray, target: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean negative log-probability of the targets, and its derivatives."""
        n = len(target)
        x = self.embedding[context].reshape(n, -1)
        hidden = np.tanh(x @ self.inner + self.inner_bias)
        scores = hidden @ self.outer + self.outer_bias
        scores -= scores.max(axis=1, keepdims=True)
        p = np.exp(scores)
        p /= p.sum(axis=1, keepdims=True)
        loss = float(-np.log(p[np.arange(n), target] + 1e-30).mean())
        p[np.arange(n), target] -= 1
        p /= n
        back = (p @ self.outer.T) * (1 - hidden * hidden)
        to_x = (back @ self.inner.T).reshape(-1, EMBEDDING)
        to_embedding = np.zeros_like(self.embedding)
        flat = context.ravel()
        order = np.argsort(flat, kind="stable")
        firsts = np.flatnonzero(np.r_[True, flat[order][1:] != flat[order][:-1]])
        to_embedding[flat[order][firsts]] = np.add.reduceat(to_x[order], firsts, axis=0)
        return loss, [to_embedding, x.T @ back, back.sum(axis=0), hidden.T @ p, p.sum(axis=0)]

    def log_probabilities(self, context: np.ndarray, target: np.ndarray, rows: int = 4096) -> np.ndarray:
        """Of each target.  The first layer is looked up: each token's share of it per place in the window."""
        cut = np.split(self.inner, len(OFFSETS))
        shares = [self.embedding @ part for part in cut]
        found = np.empty(len(target), np.float64)
        for start in range(0, len(target), rows):
            at = context[start : start + rows]
            hidden = shares[0][at[:, 0]]
            for place in range(1, len(OFFSETS)):
                hidden += shares[place][at[:, place]]
            hidden += self.inner_bias
            np.tanh(hidden, out=hidden)
            scores = hidden @ self.outer
            scores += self.outer_bias
            chosen = scores[np.arange(len(at)), target[start : start + rows]].astype(np.float64)
            np.clip(scores, -60, 60, out=scores)
            np.exp(scores, out=scores)
            found[start : start + rows] = chosen - np.log(scores.sum(axis=1, dtype=np.float64))
        return found


def round_of(stored: DataFrame, network: Network, number: int) -> Network:
    """One round over all texts.  The driver gets one row per weight."""

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, seen = network.with_values(network.flat()), 0
        squares = [np.full_like(part, 1e-2) for part in own.parts()]
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def step(context: np.ndarray, target: np.ndarray) -> None:
            _, slopes = own.gradients(context, target)
            for part, square, slope in zip(own.parts(), squares, slopes, strict=True):
                square += slope * slope
                part -= RATE * slope / np.sqrt(square)

        for batch in sliced(batches, 200):
            texts = batch.column("tokens").to_pylist()
            context, target, _ = windows(texts)
            draw = np.random.default_rng([SEED, number, zlib.crc32(b"".join(texts))])
            use = np.flatnonzero(draw.random(len(target)) < MASKED)
            draw.shuffle(use)
            held.append((context[use], target[use]))
            if sum(len(t) for _, t in held) < STEP_ROWS:
                continue
            context, target = np.concatenate([c for c, _ in held]), np.concatenate([t for _, t in held])
            whole = len(target) // STEP_ROWS * STEP_ROWS
            for start in range(0, whole, STEP_ROWS):
                step(context[start : start + STEP_ROWS], target[start : start + STEP_ROWS])
            seen += whole
            held = [(context[whole:], target[whole:])]
        rest = sum(len(t) for _, t in held)
        if rest:
            step(np.concatenate([c for c, _ in held]), np.concatenate([t for _, t in held]))
            seen += rest
        if seen:
            flat = own.flat()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(flat))), pa.array(flat * seen), pa.array(np.full(len(flat), float(seen)))],
                names=["place", "value", "seen"],
            )

    rows = stored.select("tokens").mapInArrow(trained, "place bigint, value double, seen double")
    means = rows.groupBy("place").agg((F.sum("value") / F.sum("seen")).alias("value")).collect()
    if not means:
        return network
    flat = np.empty(len(means))
    for row in means:
        flat[row.place] = row.value
    return network.with_values(flat)


def gathered(docs: DataFrame) -> tuple[DataFrame, Network, DataFrame]:
    """The stored tokens of all texts, the untrained network with the corpus shares, and word, log_share: ln p(word
    given its token) of every word that has no token of its own."""
    counts = materialise(word_counts(docs))
    frequent = counts.orderBy(F.desc("uses"), "word").limit(TOP).collect()
    numbers = {bytes(row.word): number for number, row in enumerate(frequent)}
    stored = materialise(encoded(docs, numbers))
    last = F.when(F.length("word") > 2, F.substring("word", -2, 2)).otherwise(F.col("word"))
    others = counts.filter(~F.col("word").isin(list(numbers))) if numbers else counts
    others = others.withColumn("ending", F.pmod(F.crc32(last), F.lit(ENDINGS)).cast("int"))
    shares = np.zeros(TOKENS)
    shares[: len(frequent)] = [row.uses for row in frequent]
    for row in others.groupBy("ending").agg(F.sum("uses").alias("uses")).collect():
        shares[TOP + row.ending] = row.uses
    totals = F.array(*[F.lit(float(uses)) for uses in shares[TOP:]])
    words = others.select("word", F.log(F.col("uses") / F.get(totals, F.col("ending"))).alias("log_share"))
    return stored, Network.first(shares / max(shares.sum(), 1)), words


def prepared(docs: DataFrame) -> tuple[DataFrame, Network]:
    """The stored tokens of all texts, and the untrained network with the corpus shares."""
    return gathered(docs)[:2]


def pseudo_likelihood(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, log_likelihood (sum over the words), per_word (their mean).

    ``docs`` needs doc_id and text; other columns are ignored.  Null, empty and wordless texts have no words, the sum
    0 and no mean.  Ids are passed through, repeated rows score alike.
    """
    stored, network, words = gathered(docs)
    for number in range(rounds):
        network = round_of(stored, network, number)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 100):
            texts = batch.column("tokens").to_pylist()
            context, target, row = windows(texts)
            sums = np.bincount(row, network.log_probabilities(context, target), minlength=len(texts))
            sizes = np.array([len(text) for text in texts])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(sizes.astype(np.int64)), pa.array(sums.astype(np.float64))],
                names=["row", "doc_id", "n_words", "of_tokens"],
            )

    rows = stored.select("row", "doc_id", "tokens").mapInArrow(scored, "row bigint, doc_id bigint, n_words bigint, of_tokens double")
    log_likelihood = F.col("of_tokens") + F.coalesce("within", F.lit(0.0))
    return rows.join(within_tokens(stored, words), "row", "left").select(
        "doc_id", "n_words", log_likelihood.alias("log_likelihood"),
        F.when(F.col("n_words") > 0, log_likelihood / F.col("n_words")).alias("per_word"),
    )
