"""Forests on sparse rows, against plain recursive splitting."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewmill import settings
from reviewmill.operators import classifiers, forest

WIDTH = 30


def drawn_rows(n, seed=4):
    """Sparse rows in three classes that some terms hint at; ids repeat and may be null, one row has no terms."""
    draw, rows = np.random.default_rng(seed), []
    for i in range(n):
        places = sorted(draw.choice(WIDTH, 0 if i == 0 else draw.integers(1, 9), replace=False).tolist())
        values = (0.05 + draw.random(len(places))).tolist()
        seen = sum(v for p, v in zip(places, values) if p < 8) - sum(v for p, v in zip(places, values) if p > 20)
        label = float(np.digitize(seen + 0.2 * draw.normal(), [-0.3, 0.4]))
        rows.append((None if i % 50 == 1 else i // 2, label, 0.5 + label, SparseVector(WIDTH, places, values)))
    return rows


@pytest.fixture(scope="module")
def data(spark):
    kinds = zip(("review_id", "label", "class_weight", "features"), (T.LongType(), T.DoubleType(), T.DoubleType(), VectorUDT()))
    schema = T.StructType([T.StructField(name, kind) for name, kind in kinds])
    train = classifiers.materialise(spark.createDataFrame(drawn_rows(400), schema).repartition(3, "features"))
    test = spark.createDataFrame(drawn_rows(200, 5), schema).withColumn("true_label", classifiers.decode(F.col("label"), ["a", "b", "c"]))
    return classifiers.TrainingSet(train, classifiers.materialise(test.drop("label", "class_weight")), ["a", "b", "c"], 400, WIDTH)


def plain_tree(cells, label, count, shares, depth):
    """Votes per row of a tree that looks at every term and cut, one after the other."""

    def gini(rows):
        weight = np.bincount(label[rows], count[rows], len(shares)) * shares
        return weight.sum() - (weight**2).sum() / weight.sum() if len(rows) else 0.0

    def votes(rows, levels):
        best, found = 1e-9, None
        for term in range(cells.shape[1]) if levels else ():
            for cut in range(forest.BINS - 1):
                right = cells[rows, term] > cut
                gain = gini(rows) - gini(rows[right]) - gini(rows[~right])
                if right.any() and not right.all() and gain > best + 1e-9:
                    best, found = gain, right
        if found is None:
            out[rows] = forest.votes(np.bincount(label[rows], count[rows], len(shares)), shares)
        else:
            votes(rows[~found], levels - 1), votes(rows[found], levels - 1)

    out = np.zeros((len(label), len(shares)), dtype=np.int64)
    votes(np.arange(len(label)), depth)
    return out


def test_a_part_agrees_with_plain_splitting():
    draw = np.random.default_rng(1)
    cells = (draw.integers(0, 6, (60, 12)) * (draw.random((60, 12)) < 0.4)).astype(np.uint8)
    label, count, shares = draw.integers(0, 3, 60), draw.integers(1, 4, 60), np.array([0.7, 1.0, 1.9])
    for depth in (0, 1, 4):
        tree = forest.grown(np.ascontiguousarray(cells.T), np.arange(12), label, count, shares, depth, draw, 12)
        node = forest.settled(cells, np.arange(60), np.zeros(60, dtype=np.int64), tree.feature, tree.cut, tree.left)
        assert np.array_equal(tree.votes[node], plain_tree(cells, label, count, shares, depth))


def test_by_passes_as_in_one_task(data, monkeypatch):
    """With all terms drawn there is one best tree per bag, however its nodes are shared between passes and tasks."""
    models = {}
    for small in (forest.SMALL, 60, 5):
        monkeypatch.setattr(forest, "SMALL", small)
        models[small] = forest.fit(data.train, 3, WIDTH, 5, 6, settings.SEED, drawn=WIDTH)
    sizes = [len(model.top.feature) for model in models.values()]
    assert sizes[0] == 5 < sizes[1] < sizes[2]
    rows = classifiers.materialise(data.test.select(F.monotonically_increasing_id().alias("_row"), "features"))
    found = [{r[0]: r[1] for r in forest.voted(rows, model, "_row").collect()} for model in models.values()]
    assert len(found[0]) == 200 and found[0] == found[1] == found[2]
    assert all(sum(v) == pytest.approx(5 * forest.VOTE, abs=20) for v in found[0].values())


def test_every_row_is_predicted_and_reruns_agree(data):
    """Ids repeat and are null; most rows are predicted as a plain reader would."""
    found = [classifiers.FITTED[settings.FOREST_NAME](data).collect() for _ in range(2)]
    assert sorted(map(str, found[0])) == sorted(map(str, found[1])) and len(found[0]) == 200
    assert set(found[0][0].asDict()) == {"review_id", "true_label", "predicted_label"}
    assert sum(r.review_id is None for r in found[0]) == 4
    assert np.mean([r.true_label == r.predicted_label for r in found[0]]) > 0.6


def test_bins_follow_the_quantiles(spark):
    values = (np.random.default_rng(2).random((3000, 1)) ** 2 + 1e-3).tolist()
    rows = spark.createDataFrame([([1], v) for v in values] + [([0], [0.5]), ([], [])], "indices array<int>, values array<double>")
    bins, values = forest.fit_bins(rows, 3), np.sort(np.ravel(values))
    found = bins.of(np.ones(3000, dtype=np.int64), values).astype(int)
    assert (np.diff(found) >= 0).all() and found.min() == 1 and found.max() == forest.BINS - 1
    assert np.bincount(found).max() < 3 * 3000 / (forest.BINS - 1)
    assert bins.of(np.array([0, 0, 2]), np.array([0.5, 0.0, 0.5])).tolist()[:2] == [1, 0]


def test_only_weights_from_zero_upwards(spark):
    rows = spark.createDataFrame([([0, 1], [0.5, -0.5])], "indices array<int>, values array<double>")
    with pytest.raises(ValueError, match="from 0 upwards"):
        forest.fit_bins(rows, 2)


def test_rows_stay_sparse():
    """before, a training row took a number per term (80 KB each, all rows at once) and each task up to 1 GB of sums."""
    width, draw = 20_000, np.random.default_rng(3)
    sizes = np.full(4000, 200)
    places = np.concatenate([np.sort(draw.choice(width, 200, replace=False)) for _ in sizes]).astype(np.uint16)
    bins = draw.integers(1, forest.BINS, len(places)).astype(np.uint8)
    batch = pa.RecordBatch.from_arrays([forest.as_bytes(places, sizes), forest.as_bytes(bins, sizes)], names=["places", "bins"])
    assert batch.nbytes < 4 * len(places)
    tracemalloc.start()
    seen, spread = 0, forest.Spread(width)
    for part in spread.batches([batch]):
        here = slice(200 * seen, 200 * (seen + part.num_rows))
        row = np.repeat(np.arange(part.num_rows), 200)
        assert np.array_equal(spread.cells[row, places[here]], bins[here]) and np.count_nonzero(spread.cells) == len(row)
        seen += part.num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == 4000 and not spread.cells.any() and peak < 4000 * width * 4 / 10
