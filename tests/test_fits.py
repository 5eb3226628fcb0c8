"""The fits that read all rows in every pass, against plain numpy."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewmill.operators import lda, linear
from reviewmill.operators.passes import Sparse, summed
from reviewmill.session import materialise

WIDTH = 30


def matrix(rows, width=WIDTH):
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, r.indices] = r["values"]
    return out


@pytest.fixture(scope="module")
def sparse(spark):
    """160 stored sparse rows, two without entries, with two uneven targets and weights."""
    draw = np.random.default_rng(3)
    rows = []
    for i in range(160):
        places = sorted(draw.choice(WIDTH, 0 if i < 2 else draw.integers(1, 9), replace=False).tolist())
        values = draw.random(len(places)).tolist()
        score = sum(v * math.sin(p) for p, v in zip(places, values)) + 0.2 * draw.normal()
        rows.append((i, places, values, 1.0 if score > 0.3 else -1.0, 1.0 if score < -0.5 else -1.0, 0.5 + float(draw.random()), 1.0))
    schema = "id int, indices array<int>, values array<double>, a double, b double, weight_a double, weight_b double"
    return materialise(spark.createDataFrame(rows, schema).repartition(3, "id"))


def problem(rows, free):
    return linear.Problem(rows, ("a", "b"), ("weight_a", "weight_b"), WIDTH, free)


def plain_loss(x, y, c, w, free, logistic):
    z = y * (x @ w[:-1] + w[-1])
    each = np.logaddexp(0, -z) if logistic else np.maximum(0, 1 - z) ** 2
    return (c * each).sum() + 0.5 * (w[:-1] ** 2).sum() + (0 if free else 0.5 * w[-1] ** 2)


def plain_minimum(x, y, c, free, logistic):
    """Newton's method with the full curvature matrix and halved steps."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.ones(x1.shape[1])
    penalty[-1] = 0 if free else 1
    w = np.zeros(x1.shape[1])
    for _ in range(200):
        z = y * (x1 @ w)
        if logistic:
            p = 1 / (1 + np.exp(z))
            slope, bend = -c * y * p, c * p * (1 - p)
        else:
            slope, bend = -2 * c * y * np.maximum(0, 1 - z), 2 * c * (z < 1)
        gradient = x1.T @ slope + penalty * w
        step = np.linalg.solve((x1.T * bend) @ x1 + np.diag(penalty + 1e-12), gradient)
        length = 1.0
        while plain_loss(x, y, c, w - length * step, free, logistic) > plain_loss(x, y, c, w, free, logistic) and length > 1e-9:
            length /= 2
        w = w - length * step
    return w


@pytest.mark.parametrize("logistic", [True, False])
def test_gradients_by_differences(sparse, logistic):
    for free in (True, False):
        p, w = problem(sparse, free), np.random.default_rng(1).normal(size=(WIDTH + 1, 2))
        at = linear.logistic_pass if logistic else linear.hinge_pass
        loss, gradient = at(p, w)[:2]
        rows = sparse.orderBy("id").collect()
        for m, (y, c) in enumerate((("a", "weight_a"), ("b", "weight_b"))):
            x, y, c = matrix(rows), np.array([r[y] for r in rows]), np.array([r[c] for r in rows])
            assert loss[m] == pytest.approx(plain_loss(x, y, c, w[:, m], free, logistic))
            for place in (0, 7, WIDTH):
                up, down = w[:, m].copy(), w[:, m].copy()
                up[place] += 1e-5
                down[place] -= 1e-5
                difference = (plain_loss(x, y, c, up, free, logistic) - plain_loss(x, y, c, down, free, logistic)) / 2e-5
                assert gradient[place, m] == pytest.approx(difference, abs=1e-5)


def test_curvature_by_differences(sparse):
    p, draw = problem(sparse, False), np.random.default_rng(2)
    w, d = draw.normal(size=(WIDTH + 1, 2)), draw.normal(size=(WIDTH + 1, 2))
    bent = linear.curvature_pass(p, w, d)
    slopes = [linear.hinge_pass(p, w + t * d)[1] for t in (1e-7, -1e-7)]
    assert np.allclose(bent, (slopes[0] - slopes[1]) / 2e-7, atol=1e-3)
    one = np.zeros_like(d)
    one[4] = 1
    assert np.allclose(linear.hinge_pass(p, w)[2][4], linear.curvature_pass(p, w, one)[4])


@pytest.mark.parametrize("parts", [1, 8])
def test_optima_agree_with_plain_newton(sparse, parts):
    rows = sparse.orderBy("id").collect()
    x = matrix(rows)
    for fit, free, logistic in ((linear.fit_logistic, True, True), (linear.fit_squared_hinge, False, False)):
        model = fit(problem(sparse.repartition(parts, "id"), free), tolerance=1e-6)
        assert model.converged and model.weights.shape == (WIDTH + 1, 2)
        for m, (y, c) in enumerate((("a", "weight_a"), ("b", "weight_b"))):
            expected = plain_minimum(x, np.array([r[y] for r in rows]), np.array([r[c] for r in rows]), free, logistic)
            assert np.allclose(model.weights[:, m], expected, atol=1e-4)


def test_together_as_apart(sparse):
    for fit, free in ((linear.fit_logistic, True), (linear.fit_squared_hinge, False)):
        both = fit(problem(sparse, free), tolerance=1e-6).weights
        for m, (y, c) in enumerate((("a", "weight_a"), ("b", "weight_b"))):
            alone = fit(linear.Problem(sparse, (y,), (c,), WIDTH, free), tolerance=1e-6).weights
            assert np.allclose(both[:, [m]], alone, atol=1e-4)


def test_margins_and_places(sparse):
    model = linear.fit_squared_hinge(problem(sparse, False))
    rows = sparse.orderBy("id").collect()
    expected = matrix(rows) @ model.weights[:-1] + model.weights[-1]
    scored = linear.scored(sparse.select("id", "indices", "values"), model)
    found = {r.id: (r.margins, r.place) for r in scored.withColumn("place", linear.largest(F.col("margins"))).collect()}
    assert scored.columns == ["id", "margins"]
    assert all(np.allclose(found[i][0], expected[i]) and found[i][1] == int(np.argmax(expected[i])) for i in range(len(rows)))


def test_sums_over_slices(spark, monkeypatch):
    from reviewmill.operators import passes

    monkeypatch.setattr(passes, "SLICE", 7)
    table = spark.range(1000).selectExpr("cast(id as double) as x").repartition(5)
    found = summed(table, 20, lambda batch: np.full(20, np.asarray(batch.column("x")).sum()) * np.arange(20))
    assert np.allclose(found, 499500.0 * np.arange(20))
    found = summed(table, 20, lambda batch: np.full(20, np.asarray(batch.column("x")).sum()) * np.arange(20), passes.tasks_of(table))
    assert np.allclose(found, 499500.0 * np.arange(20))
    assert not summed(table.limit(0), 20, lambda batch: np.ones(20)).any()


# --- topics ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def counts(spark):
    """Three groups of reviews, each with ten terms of its own, and one review without terms."""
    draw, rows = np.random.default_rng(5), [(0, [], [])]
    for i in range(1, 121):
        terms = np.sort(draw.choice(10, 5, replace=False)) + 10 * (i % 3)
        rows.append((i, terms.tolist(), draw.integers(1, 5, 5).astype(float).tolist()))
    return spark.createDataFrame(rows, "id int, indices array<int>, values array<double>")


def test_special_functions():
    x = np.array([1e-3, 0.125, 1.0, 2.5, 30.0, 4e4])
    assert np.allclose(lda.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-10)
    difference = [(math.lgamma(v * (1 + 1e-6)) - math.lgamma(v * (1 - 1e-6))) / (2e-6 * v) for v in x]
    assert np.allclose(lda.digamma(x), difference, rtol=1e-5)
    assert lda.digamma(np.array(1.0)) == pytest.approx(-0.5772156649015329, abs=1e-10)


def plain_topics(x, k, passes, seed, prior):
    """The same inference review by review, with dense counts."""
    parameters = np.random.default_rng(seed).gamma(100.0, 0.01, (k, x.shape[1]))
    for _ in range(passes):
        beta, uses = np.exp(lda.expected_log(parameters)), np.zeros_like(parameters)
        for row in x:
            gamma = np.ones(k) if row.any() else np.full(k, prior)
            while row.any():
                shares = np.exp(lda.expected_log(gamma[None])[0])
                new = prior + shares * (beta @ (row / (shares @ beta + lda.TINY)))
                moved, gamma = np.abs(new - gamma).mean(), new
                if moved < lda.SETTLED:
                    break
            shares = np.exp(lda.expected_log(gamma[None])[0])
            uses += np.outer(shares, row / (shares @ beta + lda.TINY)) * beta
        parameters = prior + uses
    return parameters


def test_batch_inference_against_review_by_review(counts):
    x = matrix(counts.orderBy("id").collect())
    expected = plain_topics(x, 3, 6, 7, 1 / 3)
    for parts in (1, 8):
        model = lda.fit(counts.repartition(parts, "id"), 3, WIDTH, 6, 7)
        assert np.allclose(model.parameters, expected, atol=1e-6)


def test_every_token_counts_and_the_bound_rises(counts):
    model = lda.fit(counts, 3, WIDTH, 12, 7)
    tokens = counts.selectExpr("aggregate(values, 0D, (s, v) -> s + v) as n").agg(F.sum("n")).first()[0]
    bounds = [bound for bound, _, _ in model.passes]
    assert all(b >= a - 1e-6 * abs(a) for a, b in zip(bounds, bounds[1:]))
    assert all(uses == pytest.approx(tokens) and seen == tokens for _, uses, seen in model.passes)
    groups = {tuple(sorted({term // 10 for term in terms})) for terms in model.top_terms(10)}
    assert groups == {(0,), (1,), (2,)}
    shares = {r.id: r.topicDistribution for r in model.assigned(counts).collect()}
    assert shares[0] == pytest.approx([1 / 3] * 3) and all(sum(s) == pytest.approx(1) for s in shares.values())
    assert len({int(np.argmax(shares[i])) for i in range(1, 121, 3)}) == 1


def test_rows_of_a_batch():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict(
        {"indices": pa.array([[0, 2], [], [1], None], pa.list_(pa.int32())), "values": pa.array([[1.0, 2.0], [], [3.0], None], pa.list_(pa.float64()))}
    )
    rows = Sparse(batch.slice(1))
    assert rows.rows == 3 and rows.times(np.array([[1.0], [10.0], [100.0]])).ravel().tolist() == [0, 30, 0]


def entries(sizes, width, seed=5):
    import pyarrow as pa

    draw = np.random.default_rng(seed)
    indices = [sorted(draw.choice(width, n, replace=False).tolist()) for n in sizes]
    values = [draw.integers(1, 9, n).astype(float).tolist() for n in sizes]
    return Sparse(
        pa.RecordBatch.from_pydict({"indices": pa.array(indices, pa.list_(pa.int32())), "values": pa.array(values, pa.list_(pa.float64()))})
    )


def test_a_review_settles_alone_as_among_others():
    """before, a settled review went on with those still moving, and a batch filled arrays of all its terms by topic."""
    import tracemalloc

    sizes = [0, 1, 300, 2, 0, 40, *range(1, 200)]
    rows, topics = entries(sizes, 400), np.exp(lda.expected_log(np.random.default_rng(1).gamma(100.0, 0.01, (8, 400)))).T
    together = lda.topic_numbers(rows, topics, 1 / 8)
    for i in range(len(sizes)):
        alone = entries(sizes, 400)
        mine = alone.row == i
        alone.row, alone.column, alone.value, alone.rows = alone.row[mine] - i, alone.column[mine], alone.value[mine], 1
        assert np.allclose(lda.topic_numbers(alone, topics, 1 / 8)[0], together[i], atol=1e-9)
    many = entries([200] * 2000, 400)
    tracemalloc.start()
    lda.topic_numbers(many, topics, 1 / 8)
    assert tracemalloc.get_traced_memory()[1] < len(many.row) * 8 * 8


def test_sums_of_rows_and_columns_are_quick():
    """every pass multiplies all rows by all models twice; before, by scattered places, three times as slow."""
    import time

    rows = entries([0, *[140] * 2000, 0], 5000)
    weights = np.random.default_rng(1).normal(size=(5000, 5))
    dense = np.zeros((rows.rows, 5000))
    dense[rows.row, rows.column] = rows.value

    def plain():
        each = [np.bincount(rows.row, rows.value * weights[rows.column, m], rows.rows) for m in range(5)]
        return np.stack(each, 1)

    def seconds(call):
        best = []
        for _ in range(7):
            begun = time.perf_counter()
            call()
            best.append(time.perf_counter() - begun)
        return min(best)

    assert np.allclose(rows.times(weights), dense @ weights)
    for power in (1, 2):
        assert np.allclose(rows.transposed_times(dense @ weights, 5000, power), (dense**power).T @ (dense @ weights))
    assert seconds(lambda: rows.times(weights)) < 0.7 * seconds(plain)
