"""Toxicity: a lexicon trie met by Levenshtein automata, and context windows around each hit.

The lexicon holds seed words and the words and stems that a bounded sample of labelled texts shows to be far more
frequent in toxic ones.  The automaton accepts a word that differs from a lexicon word by few edits (letters
changed, added, lost or swapped); it is intersected with the trie, so all terms are matched in one walk over
the word, and most words end after two or three letters.  A hit counts less in quotation marks or next to words
of reporting, and more next to words of address.  A logistic regression over a document's hits, fitted on the
sample, gives the score.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.shared import id_text, sliced

# Seed terms and the cues of context windows.
SEEDS = ["asshole", "bastard", "clown", "dumbass", "garbage", "idiot", "imbecile", "loser", "moron", "pathetic", "scumbag", "stupid", "worthless"]
REPORTING = {"called", "calling", "phrase", "quote", "quoted", "said", "says", "slur", "term", "word", "words", "wrote"}
ADDRESS = {"he", "she", "they", "u", "ur", "you", "your", "youre"}

# The sample that lexicon and regression are learned from: labelled rows at most.
SAMPLE_ROWS = 10_000
# A learned term is in at least so many toxic texts, and its excess over chance, in nats, is at least this.
FEWEST_TEXTS, LEAST_EVIDENCE = 4, 12.0
LEAST_PRECISION = 0.8
MOST_TERMS = 300
WINDOW = 5
WORD = re.compile(r"[^\W_]+")
# Quotation marks and the end of a line.
MARKS = '"“”«»„\n'
ANY_MARK = re.compile(f"[{MARKS}]")
END = "$"


@dataclass(frozen=True)
class Term:
    """``text`` ends with END if it is a whole word; otherwise it is a stem, which any ending may follow."""

    text: str
    weight: float

    @property
    def edits(self) -> int:
        """Misspellings allowed: none for stems and words under five letters, two from nine letters on."""
        letters = len(self.text) - 1
        return 0 if not self.text.endswith(END) or letters < 5 else 1 if letters < 9 else 2


class Automaton:
    """The Levenshtein automata of all terms, intersected with their trie and made deterministic as it is used.

    A state is a set of (trie node, swapped letter still to come, edits so far).  There are as many states as
    the terms allow, whatever the texts: letters in no term are one letter.
    """

    def __init__(self, terms: list[Term]):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.term_at: list[int | None] = [None]
        self.allowed: list[int] = [0]
        for number, term in enumerate(terms):
            node = 0
            for letter in term.text:
                self.allowed[node] = max(self.allowed[node], term.edits)
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term_at.append(None)
                    self.allowed.append(0)
                node = self.children[node][letter]
            self.allowed[node] = max(self.allowed[node], term.edits)
            self.term_at[node] = number
        self.alphabet = {letter for term in terms for letter in term.text}
        self.states: list[dict] = []
        self.accepts: list[tuple[int, int] | None] = []
        self.table: list[dict[str, int]] = []
        self.numbers: dict[frozenset, int] = {}
        self.start = self.number_of(self.closed({(0, ""): 0}))

    def closed(self, state: dict) -> dict:
        """With the nodes that lost letters lead to."""
        todo = list(state.items())
        while todo:
            (node, pending), edits = todo.pop()
            if pending:
                continue
            for letter, child in self.children[node].items():
                if letter != END and edits < self.allowed[child] and state.get((child, ""), 9) > edits + 1:
                    state[child, ""] = edits + 1
                    todo.append(((child, ""), edits + 1))
        return state

    def number_of(self, state: dict) -> int:
        key = frozenset(state.items())
        if key not in self.numbers:
            self.numbers[key] = len(self.states)
            self.states.append(state)
            self.table.append({})
            ends = [(edits, self.term_at[node]) for (node, pending), edits in state.items() if not pending and self.term_at[node] is not None]
            self.accepts.append(min((end for end in ends if end[0] <= self.terms[end[1]].edits), default=None))
        return self.numbers[key]

    def step(self, state: dict, letter: str) -> dict:
        following: dict = {}

        def reach(node: int, pending: str, edits: int) -> None:
            if edits <= self.allowed[node] and following.get((node, pending), 9) > edits:
                following[node, pending] = edits

        for (node, pending), edits in state.items():
            if pending:
                if letter == pending:
                    reach(node, "", edits)
                continue
            for known, child in self.children[node].items():
                if known == letter:
                    reach(child, "", edits)
                elif END not in (known, letter):
                    reach(child, "", edits + 1)
                    if letter in self.children[child]:
                        reach(self.children[child][letter], known, edits + 1)
            if letter != END:
                reach(node, "", edits + 1)
        return self.closed(following)

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term) of the best term that the word is or begins with; None if there is none."""
        at, found = self.start, None
        for letter in word + END:
            letter = letter if letter in self.alphabet else "\0"
            following = self.table[at].get(letter)
            if following is None:
                following = self.table[at][letter] = self.number_of(self.step(self.states[at], letter))
            at = following
            if not self.states[at]:
                break
            accepted = self.accepts[at]
            if accepted is not None and (found is None or accepted < found):
                found = accepted
        return found


class Quotations:
    """The quotation marks and line breaks of a text, found once, so that a long line with many hits takes linear time."""

    def __init__(self, text: str):
        self.size = len(text)
        self.places: dict[str, list[int]] = {mark: [] for mark in MARKS}
        for m in ANY_MARK.finditer(text):
            self.places[m[0]].append(m.start())

    def last(self, mark: str, first: int, end: int) -> int:
        """Place of the last one from first to end, -1 if there is none."""
        at = bisect_left(self.places[mark], end) - 1
        return self.places[mark][at] if at >= 0 and self.places[mark][at] >= first else -1

    def count(self, mark: str, first: int, end: int) -> int:
        return bisect_left(self.places[mark], end) - bisect_left(self.places[mark], first)

    def hold(self, start: int, end: int) -> bool:
        """Whether the span stands between quotation marks on its line."""
        line = self.last("\n", 0, start) + 1
        breaks = self.places["\n"]
        at = bisect_left(breaks, end)
        stop = breaks[at] if at < len(breaks) else self.size
        pairs = any(self.last(a, line, start) > self.last(b, line, start) and self.count(b, end, stop) for a, b in ("“”", "«»", "„“"))
        return pairs or (self.count('"', line, start) % 2 == 1 and self.count('"', end, stop) > 0)


@dataclass
class Lexicon:
    terms: list[Term]
    exceptions: frozenset[str] = frozenset()
    remembered: int = 500_000
    automaton: Automaton = field(init=False, repr=False)
    known: dict[str, tuple[int, int] | None] = field(init=False, repr=False, default_factory=dict)

    def __post_init__(self) -> None:
        self.automaton = Automaton(self.terms)

    def __reduce__(self):
        return Lexicon, (self.terms, self.exceptions, self.remembered)

    def hit(self, word: str) -> tuple[int, int] | None:
        if word in self.known:
            return self.known[word]
        found = self.automaton.match(word)
        if found and found[0] and word in self.exceptions:
            found = None
        if len(self.known) >= self.remembered:
            self.known.clear()
        self.known[word] = found
        return found

    def features(self, text: str) -> tuple[list[float], list[str]]:
        """Strongest and summed weight of abusive hits, quoted or reported hits, hits by a misspelling, and the
        misspelled words."""
        text = text.lower()
        known, hit = self.known, self.hit
        hits = [word for word in WORD.findall(text) if (known[word] if word in known else hit(word))]
        if not hits:
            return [0.0, 0.0, 0.0, 0.0], []
        words, quotations = list(WORD.finditer(text)), Quotations(text)
        strongest = total = reported = misspelled = 0.0
        for i, word in enumerate(words):
            found = hit(word[0])
            if not found:
                continue
            edits, term = found
            around = {w[0] for w in words[max(0, i - WINDOW) : i]} | {w[0] for w in words[i + 1 : i + 1 + WINDOW]}
            weight = self.terms[term].weight * 0.8**edits
            if quotations.hold(*word.span()) or around & REPORTING:
                weight, reported = weight * 0.2, reported + 1
            elif around & ADDRESS:
                weight *= 1.2
            strongest, total, misspelled = max(strongest, weight), total + weight, misspelled + (edits > 0)
        return [strongest, math.log1p(total), math.log1p(reported), math.log1p(misspelled)], sorted({w for w in hits if hit(w)[0]})


def crc_of_id() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))


def training_sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """doc_id, text, toxic of ``rows`` labelled rows at most, chosen by a hash of the id; held-out ids never."""
    usable = labels.filter(crc_of_id() != 0).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).filter("toxic is not null")
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").filter("text is not null")


def learned_terms(sample: DataFrame) -> list[Term]:
    """Words and stems of the sample's toxic texts.  A stem gives way to a longer one that nearly all its toxic texts
    share, so terms are as long as the evidence allows; a term that begins with a chosen stem adds nothing."""
    totals = sample.agg(F.count("*").alias("texts"), F.sum("toxic").alias("toxic")).first()
    if not totals.texts or not totals.toxic or totals.toxic == totals.texts:
        return []
    words = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))
    lengths = F.sequence(F.lit(3), F.least(F.length("word"), F.lit(12)) + F.lit(1))
    pieces = (
        sample.select("doc_id", "toxic", F.explode(words).alias("word"))
        .filter("length(word) >= 3")
        .select("doc_id", "toxic", F.explode(F.transform(lengths, lambda n: F.substring(F.concat("word", F.lit(END)), F.lit(1), n))).alias("piece"))
        .groupBy("doc_id", "toxic", "piece")
        .agg(F.lit(1).alias("one"))
    )
    base = totals.toxic / totals.texts
    share = F.col("hits") / F.col("texts")
    evidence = F.col("texts") * (share * F.log(share / base) + F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0))
    counted = (
        pieces.groupBy("piece").agg(F.count("*").alias("texts"), F.sum("toxic").alias("hits"))
        .filter((F.col("hits") >= FEWEST_TEXTS) & (F.col("hits") / (F.col("texts") + 1) >= LEAST_PRECISION))
        .withColumn("evidence", evidence)
        .filter(F.col("evidence") >= LEAST_EVIDENCE)
        .select("piece", "texts", "hits", "evidence")
        .collect()  # pieces of a bounded sample
    )
    longer: dict[str, int] = {}
    for row in counted:
        longer[row.piece[:-1]] = max(longer.get(row.piece[:-1], 0), row.hits)
    kept = [row for row in counted if longer.get(row.piece, 0) < 0.9 * row.hits]
    chosen: dict[str, Term] = {}
    for row in sorted(kept, key=lambda row: (-row.evidence, row.piece)):
        if len(chosen) < MOST_TERMS and not any(row.piece[:n] in chosen for n in range(3, len(row.piece))):
            chosen[row.piece] = Term(row.piece, row.hits / (row.texts + 1))
    return list(chosen.values())


def fitted(features: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's method with a small ridge; the intercept comes last."""
    x = np.hstack([features, np.ones((len(features), 1))])
    weights = np.zeros(x.shape[1])
    ridge = np.diag([1e-2] * features.shape[1] + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (labels - p) - ridge @ weights)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


#: Without labelled rows of both kinds: one clear hit is toxic.
UNTRAINED = np.array([5.0, 0.5, 0.0, 0.0, -3.0])


@dataclass(frozen=True)
class Model:
    lexicon: Lexicon
    weights: np.ndarray

    def score(self, text: str) -> float:
        features, _ = self.lexicon.features(text)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, float(np.dot(self.weights, [*features, 1.0]))))))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Lexicon and regression from ``sample_rows`` labelled rows at most.  The driver gets four numbers and the
    misspellings of each."""
    sample = training_sample(docs, labels, sample_rows)
    learned = learned_terms(sample)
    seeds = [Term(word + END, 0.9) for word in SEEDS if word + END not in {term.text for term in learned}]
    lexicon = Lexicon(learned + seeds)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 500):
            rows = [lexicon.features(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array([x for x, _ in rows], pa.list_(pa.float64())), pa.array([w for _, w in rows], pa.list_(pa.string()))],
                names=["toxic", "x", "misspelled"],
            )

    schema = "toxic int, x array<double>, misspelled array<string>"
    rows = sample.select("text", "toxic").mapInArrow(measured, schema).collect()
    toxic = np.array([row.toxic for row in rows], float)
    seen: dict[str, list[int]] = {}
    for row in rows:
        for word in row.misspelled:
            seen.setdefault(word, []).append(row.toxic)
    exceptions = frozenset(word for word, each in seen.items() if sum(each) < 0.5 * len(each))
    if not 0 < toxic.sum() < len(toxic):
        return Model(Lexicon(lexicon.terms, exceptions), UNTRAINED)
    return Model(Lexicon(lexicon.terms, exceptions), fitted(np.array([row.x for row in rows]), toxic))


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row: a map over whole texts, without a shuffle."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 500):
            each = [model.score(text or "") for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(each, pa.float64()), pa.array([int(s >= 0.5) for s in each], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(crc_of_id() == 0, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(scored, "doc_id bigint, held_out boolean, score double, predicted int")


def toxic_scores(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out (crc32 of the id as text is divisible by 5), score, predicted.

    ``docs`` needs doc_id and text, ``labels`` doc_id and toxic; other columns are ignored.  Null and empty texts
    score as texts without hits.  A null id is not held out.  Of repeated labels the higher counts.  Without labelled
    rows of both kinds the seed words and fixed weights decide.
    """
    return scores(docs, train(docs, labels, sample_rows))


def without_toxic(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` whose score is below 0.5, with all their columns."""
    model = train(docs, labels, sample_rows)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 500):
            keep = [model.score(text or "") < 0.5 for text in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(clean, docs.schema)
