from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from reviewmill.llm import hard_negatives

NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    """Every anchor against every row."""
    known = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) or abs(x) >= 2**20 for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        known.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    out = Counter()
    for a, (anchor, v, label) in enumerate(known):
        if anchor is None or anchor % 50:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(v, w)), other is None, other or 0, other, theirs == label) for b, (other, w, theirs) in enumerate(known) if a != b
        )
        for score, _, _, positive, _ in [s for s in scored if s[4]][:5]:
            negatives = [s for s in scored if not s[4] and 50 * -score <= 100 * -s[0] <= 95 * -score]
            for rank, (other, _, _, negative, _) in enumerate(negatives[:3], 1):
                out[anchor, positive, rank, negative, -score, -other] += 1
    return out


def found(df):
    return Counter(tuple(r) for r in hard_negatives.mine(df).select(*NAMES).collect())


@pytest.fixture(scope="module")
def rows():
    """Clustered vectors of small whole components (many ties), copies, odd lengths and values, repeated and missing ids."""
    draw = random.Random(4)
    centres = [[draw.gauss(0, 1) for _ in range(11)] for _ in range(4)]
    out = []
    for i in range(420):
        centre = centres[draw.randrange(4)]
        vector = [round(c + draw.gauss(0, 0.3), 1 if i % 2 else 3) for c in centre]
        out.append((i, vector, draw.randrange(4)))
    out += [(500 + i, [1.0] * 11, i % 3) for i in range(60)]  # one vector many times
    out += [(600, None, 1), (601, [1.0, None], 1), (602, [float("nan")] * 11, 1), (603, [float("inf")] * 11, 2), (604, [1.0] * 11, None)]
    out += [(None, [1.0] * 11, 1), (None, [0.9] * 11, 2), (650, [2.0] * 3, 1), (700, [], 2), (750, [0.0] * 11, 3), (800, [3e6] * 11, 3)]
    out += [(100, [0.5] * 11, 2), (100, [0.5] * 11, 2), (850, [-1.0] * 11, 1), (-50, [1.0] * 14, 0), (-7, [1.0] * 14, -3)]
    return out


def test_against_all_pairs(spark, rows, monkeypatch):
    df = spark.createDataFrame(rows, SCHEMA)
    expected = plain(rows)
    assert expected and found(df) == expected
    monkeypatch.setattr(hard_negatives, "GROUP", 30)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 4)
    monkeypatch.setattr(hard_negatives, "AT_ONCE", 3)
    monkeypatch.setattr(hard_negatives, "DENSE", 2.0)
    assert found(df.repartition(3)) == expected


def test_bounds_hold_and_narrow():
    draw = np.random.default_rng(1)
    a, b = np.floor(draw.normal(0, 300, (20, 64))), np.floor(draw.normal(50, 300, (30, 64)))
    b[0], b[1] = a[0], 7
    pairs, at, every = hard_negatives.Bounded(a, b), np.arange(20), np.ones((20, 30), bool)
    exact, before = a @ b.T, None
    assert (pairs.scores(at, every) == exact).all()
    for level in range(len(hard_negatives.LEVELS)):
        low, high = pairs.bounds(level, at, every)
        assert (low <= exact).all() and (exact <= high).all()
        few = np.zeros_like(every)
        few[3, 4] = True
        assert pairs.bounds(level, at, few)[0][3, 4] == pytest.approx(low[3, 4])
        assert before is None or (high - low).sum() < before
        before = (high - low).sum()


def test_bounds_discard_what_they_can():
    """Vectors that are constant within segments are decided without exact scores."""
    draw = np.random.default_rng(2)
    a, b = (np.repeat(draw.integers(-50, 50, (n, 4)), 16, 1).astype(float) for n in (5, 400))
    pairs, at = hard_negatives.Bounded(a, b), np.arange(5)
    scores = hard_negatives.best_positives(pairs, at, np.ones((5, 400), bool))
    left = scores > np.iinfo(np.int64).min
    assert left.sum(1).max() < 40
    assert (np.sort(np.where(left, a @ b.T, -np.inf), 1)[:, -5:] == np.sort(a @ b.T, 1)[:, -5:]).all()


def test_large_components_are_summed_exactly():
    a = np.full((1, 64), float((1 << 27) - 1))
    pairs = hard_negatives.Bounded(a, a)
    assert not pairs.exact() and pairs.scores(np.arange(1), np.ones((1, 1), bool))[0, 0] == 64 * ((1 << 27) - 1) ** 2


def test_empty_and_clashing(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    extra = df.select("*", *[F.lit("x").alias(name) for name in ("row", "v", "group", "block", "scores", "rank")])
    assert found(extra) == plain(rows)
    assert hard_negatives.mine(df.limit(0)).count() == 0
    assert hard_negatives.mine(df.filter("vec_id = 1")).count() == 0
