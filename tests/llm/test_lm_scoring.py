from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from reviewmill.llm import lm_scoring as lm
from tests_llm import frame


def small_network():
    return lm.Network.first(np.full(lm.TOKENS, 1 / lm.TOKENS))


def test_gradients_agree_with_differences():
    draw = np.random.default_rng(2)
    network = small_network()
    context, target = draw.integers(0, lm.TOKENS, (40, 4)), draw.integers(0, lm.TOKENS, 40)
    loss, slopes = network.gradients(context, target)
    assert loss == pytest.approx(-network.log_probabilities(context, target).mean(), rel=1e-5)
    for part, slope in zip(network.parts(), slopes, strict=True):
        flat, slope = part.reshape(-1), slope.reshape(-1)
        for place in draw.choice(np.flatnonzero(np.abs(slope) > 1e-4), 5):
            kept, step = flat[place], np.float32(1e-2)
            flat[place] = kept + step
            up = network.gradients(context, target)[0]
            flat[place] = kept - step
            down = network.gradients(context, target)[0]
            flat[place] = kept
            assert (up - down) / (2 * float(step)) == pytest.approx(slope[place], rel=0.05, abs=2e-4)


def test_probabilities_sum_to_one_and_windows_stay_in_their_text():
    network = small_network()
    context, target, row = lm.windows([bytes([1, 2, 3]), b"", bytes([4])])
    assert context.tolist() == [[lm.PAD, lm.PAD, 2, 3], [lm.PAD, 1, 3, lm.PAD], [1, 2, lm.PAD, lm.PAD], [lm.PAD] * 4]
    assert target.tolist() == [1, 2, 3, 4] and row.tolist() == [0, 0, 0, 2]
    every = np.repeat(context[:1], lm.TOKENS, axis=0)
    assert np.exp(network.log_probabilities(every, np.arange(lm.TOKENS))).sum() == pytest.approx(1, abs=1e-4)


def test_word_counts_cover_all_texts(documents, given):
    expected = Counter(word for r in given for word in lm.words_of(r.text))
    assert {bytes(r.word): r.uses for r in lm.word_counts(documents).collect()} == dict(expected)


def pattern(n, seed):
    """Words that their neighbours give away: a b c d follow each other, with noise."""
    draw = random.Random(seed)
    order, words, at = ["aa", "bb", "cc", "dd"], [], 0
    for _ in range(n):
        words.append(order[at % 4])
        at += 1
    return " ".join(words if seed >= 0 else draw.sample(words, len(words)))


def test_likely_texts_score_higher_than_shuffled_ones(spark):
    rows = [(i, pattern(400, i), "en", "a", 0) for i in range(60)] + [(1000 + i, pattern(400, -1 - i), "en", "a", 0) for i in range(3)]
    got = {r.doc_id: r for r in lm.pseudo_likelihood(frame(spark, rows).coalesce(2)).collect()}
    fluent = sum(got[i].per_word for i in range(60)) / 60
    assert fluent > -0.7 > -math.log(4) and all(got[1000 + i].per_word < fluent - 1 for i in range(3))
    assert all(r.log_likelihood == pytest.approx(r.per_word * r.n_words) for r in got.values())


def test_training_beats_the_shares_of_words(spark):
    stored, network = lm.prepared(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    context, target, _ = lm.windows([bytes(r.tokens) for r in stored.collect()])
    before = network.log_probabilities(context, target).mean()
    for number in range(lm.ROUNDS):
        network = lm.round_of(stored, network, number)
    assert network.log_probabilities(context, target).mean() > before + 0.1


def test_awkward_documents(awkward, awkward_rows, nothing):
    got = lm.pseudo_likelihood(awkward).collect()
    assert Counter((r.doc_id, r.n_words) for r in got) == Counter((i, len(lm.words_of(t))) for i, t, *_ in awkward_rows)
    assert all((r.per_word is None) == (r.n_words == 0) and (r.n_words or r.log_likelihood == 0) for r in got)
    alike = [r.log_likelihood for r in got if r.doc_id in (7, 8)]
    assert max(alike) == pytest.approx(min(alike))
    assert lm.pseudo_likelihood(nothing).count() == 0


def test_words_that_share_a_token_score_by_their_own_counts(spark):
    """A word used once is less likely than a common word of the same ending, by the ratio of their uses."""
    common = " ".join(f"w{i}" for i in range(lm.TOP))
    rows = [(i, f"{common} {common} oftenxyz", "en", "a", 0) for i in range(40)]
    rows += [(100, "w1 w2 oftenxyz w3 w4", "en", "a", 0), (101, "w1 w2 oncexyz w3 w4", "en", "a", 0), (102, "w1 w2 oncexyz oncexyz w4", "en", "a", 0)]
    docs = frame(spark, rows)
    got = {r.doc_id: r for r in lm.pseudo_likelihood(docs, rounds=0).collect()}
    assert got[100].log_likelihood - got[101].log_likelihood == pytest.approx(math.log(41 / 3), abs=1e-4)
    stored, _, words = lm.gathered(docs)
    assert {bytes(r.word): r.log_share for r in words.collect()} == pytest.approx({b"oftenxyz": math.log(41 / 44), b"oncexyz": math.log(3 / 44)})
    ids = {r.row: r.doc_id for r in stored.collect()}
    within = {ids[r.row]: r.within for r in lm.within_tokens(stored, words).collect()}
    assert within == pytest.approx({**dict.fromkeys([*range(40), 100], math.log(41 / 44)), 101: math.log(3 / 44), 102: 2 * math.log(3 / 44)})
