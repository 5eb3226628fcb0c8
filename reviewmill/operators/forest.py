"""Random forests on sparse rows.

Bootstrap by Poisson counts, Gini gain with weighted classes, a new draw of the square root of the terms at every node, at
most 32 bins per term (0, and the rest by the term's quantiles).  Large nodes are split level by level: a pass over the
stored rows counts (node, drawn term, bin, class) where the term occurs, the counts are summed per node over the cluster,
and only the best split of each node comes to the driver.  A node with at most ``SMALL`` rows is finished in
one task, to which its rows are sent once.  Finished parts stay in a stored table, and rows to predict meet them there.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewmill.operators.passes import Sparse, as_bytes, as_rows, flat, place_type, sliced, summed, tasks_of
from reviewmill.session import materialise

#: Bins per term, the first for 0, and buckets of the values' logarithms that the others are made of.
BINS, BUCKETS = 32, 128
#: Rows that a task finishes a node with, and cells (rows times terms) that it may spread out for that.
SMALL, CELLS = 8192, 160_000_000
#: Cells that a pass spreads out at a time; pairs of a row and a tree that it looks at together.
SPREAD, PAIRS = 10_000_000, 2048
#: Counts that a task gathers before it sums them, and sums that it holds.
GATHERED, HELD = 2_000_000, 1_000_000
#: Rows per task of a pass, and rows of finished nodes per task.
ROWS, FINISHED = 5_000, 20_000
#: The whole vote of a tree; integers, so that sums don't depend on their order.
VOTE = 1 << 32


@dataclass(frozen=True)
class Bins:
    """The bin of every term and bucket; a bucket is a share of the logarithms between the two bounds."""

    table: np.ndarray
    low: float
    high: float

    def of(self, column: np.ndarray, value: np.ndarray) -> np.ndarray:
        return np.where(value > 0, self.table[column, buckets(value, self.low, self.high)], 0).astype(np.uint8)


def buckets(value: np.ndarray, low: float, high: float) -> np.ndarray:
    if high <= low:
        return np.zeros(len(value), dtype=np.int64)
    share = (np.log(np.maximum(value, low)) - math.log(low)) / (math.log(high) - math.log(low))
    return np.clip((share * BUCKETS).astype(np.int64), 0, BUCKETS - 1)


def fit_bins(rows: DataFrame, width: int) -> Bins:
    """Bins by quantiles of each term's values above 0, over all rows."""
    above = F.filter("values", lambda v: v > 0)
    low, high, least = rows.agg(F.min(F.array_min(above)), F.max(F.array_max(above)), F.min(F.array_min("values"))).first()
    if least is not None and least < 0:
        raise ValueError(f"a forest takes weights from 0 upwards, found {least}")
    if low is None:
        return Bins(np.zeros((width, BUCKETS), dtype=np.uint8), 1.0, 1.0)

    def statistics(batch: pa.RecordBatch) -> np.ndarray:
        found = Sparse(batch)
        used = found.value > 0
        return np.bincount(found.column[used] * BUCKETS + buckets(found.value[used], low, high), minlength=width * BUCKETS)

    counts = summed(rows.select("indices", "values"), width * BUCKETS, statistics, tasks_of(rows)).reshape(width, BUCKETS)
    before = np.cumsum(counts, 1) - counts
    table = 1 + (BINS - 1) * before // np.maximum(counts.sum(1, keepdims=True), 1)
    return Bins(np.minimum(table, BINS - 1).astype(np.uint8), low, high)


def binned(rows: DataFrame, bins: Bins, width: int, trees: int, seed: int, keep: str) -> DataFrame:
    """(``keep``, places, bins, bag) with the entries of a row as bytes and how often each tree drew it (0 trees: not)."""
    kind, low, high, table = place_type(width), bins.low, bins.high, bins.table
    name, sql_type = keep.split()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = np.random.default_rng((seed, TaskContext.get().partitionId()))
        for batch in sliced(batches):
            found = Sparse(batch)
            bag = np.minimum(draw.poisson(1.0, (found.rows, trees)), 255).astype(np.uint8)
            columns = [
                batch.column(name),
                as_bytes(found.column.astype(kind), found.sizes),
                as_bytes(Bins(table, low, high).of(found.column, found.value), found.sizes),
                as_bytes(bag.ravel(), np.full(found.rows, trees)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[name, "places", "bins", "bag"])

    return rows.select(F.col(name).cast(sql_type), "indices", "values").mapInArrow(task, f"{keep}, places binary, bins binary, bag binary")


class Spread:
    """Rows with a cell per term, used again from batch to batch."""

    def __init__(self, width: int):
        self.width, self.most = width, max(16, SPREAD // width)
        self.cells = np.zeros((self.most, width), dtype=np.uint8)

    def batches(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, self.most):
            places, sizes = flat(batch.column("places"), place_type(self.width))
            row = np.repeat(np.arange(len(sizes)), sizes)
            self.cells[row, places] = flat(batch.column("bins"), np.uint8)[0]
            yield batch
            self.cells[row, places] = 0


def settled(cells: np.ndarray, row: np.ndarray, node: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Where rows end up from their nodes; a row goes left if its bin is at most the cut."""
    node = node.copy()
    going = np.arange(len(node))
    while True:
        going = going[feature[node[going]] >= 0]
        if not len(going):
            return node
        at = node[going]
        node[going] = left[at] + (cells[row[going], feature[at]] > cut[at])


def best_split(
    cell: np.ndarray, label: np.ndarray, number: np.ndarray, total: np.ndarray, shares: np.ndarray
) -> tuple[int, int, np.ndarray] | None:
    """Of counts per cell (term * BINS + bin, bins above 0) and class the term and last left bin with the largest Gini
    gain, and the counts on the left; None if nothing gains.  ``shares``: weight of a row per class."""
    if not len(cell):
        return None
    classes = len(total)
    cell, place = np.unique(cell, return_inverse=True)
    counts = np.bincount(place * classes + label, number, len(cell) * classes).reshape(-1, classes)
    term = cell // BINS
    # A term's rows in a bin or a higher one, from the sums of this and all later cells.
    later = np.zeros((len(cell) + 1, classes))
    later[:-1] = np.cumsum(counts[::-1], 0)[::-1]
    above = later[:-1] - later[np.searchsorted(term, term, "right")]
    below = total - above

    def rest(numbers: np.ndarray) -> np.ndarray:
        weight = numbers * shares
        whole = weight.sum(-1)
        return whole - (weight * weight).sum(-1) / np.maximum(whole, 1e-300)

    gain = rest(total) - rest(below) - rest(above)
    gain[below.sum(-1) <= 0] = 0
    best = int(np.argmax(gain))
    if gain[best] <= 1e-12 * (total * shares).sum():
        return None
    cut = cell[best - 1] % BINS if best and term[best - 1] == term[best] else 0
    return int(term[best]), int(cut), below[best]


def votes(total: np.ndarray, shares: np.ndarray) -> np.ndarray:
    weight = total * shares
    return np.rint(VOTE * weight / max(weight.sum(), 1e-300)).astype(np.int64)


def drawn_terms(draw: np.random.Generator, width: int, drawn: int) -> np.ndarray:
    return np.sort(draw.choice(width, drawn, replace=False, shuffle=False))


@dataclass(frozen=True)
class Tree:
    """Term (-1: a leaf), cut and left child (the right one follows it) of every node, and the leaves' votes."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    votes: np.ndarray


def grown(
    cells: np.ndarray, known: np.ndarray, label: np.ndarray, count: np.ndarray, shares: np.ndarray, depth: int,
    draw: np.random.Generator, drawn: int,
) -> Tree:
    """A node finished in memory.  ``cells``: a row of bins per term that its rows have, so that a term's bins stand together;
    ``known``: the place of every term, or -1."""
    classes, width = len(shares), len(known)
    feature, cut, left, found = [-1], [0], [0], [None]
    todo = [(0, np.arange(len(label)), depth)]
    while todo:
        node, rows, levels = todo.pop()
        total = np.bincount(label[rows], count[rows], classes)
        split = None
        if levels > 0 and np.count_nonzero(total) > 1:
            terms = drawn_terms(draw, width, drawn)
            terms = terms[known[terms] >= 0]
            looked = cells[known[terms][:, None], rows]
            term, row = np.nonzero(looked)
            split = best_split(term * BINS + looked[term, row], label[rows[row]], count[rows[row]], total, shares)
        if split is None:
            found[node] = votes(total, shares)
            continue
        feature[node], cut[node], left[node] = int(terms[split[0]]), split[1], len(feature)
        right = looked[split[0]] > split[1]
        for part in (rows[~right], rows[right]):
            todo.append((len(feature), part, levels - 1))
            feature.append(-1), cut.append(0), left.append(0), found.append(None)
    none = np.zeros(classes, dtype=np.int64)
    kept = np.stack([none if v is None else v for v in found])
    return Tree(np.array(feature, np.int32), np.array(cut, np.uint8), np.array(left, np.int32), kept)


@dataclass(frozen=True)
class Forest:
    """The large nodes of all trees (``top``; the roots come first), which of their ends are finished in ``parts``
    (node, feature, cut, left, votes as bytes), and how texts' weights become bins."""

    top: Tree
    finished: np.ndarray
    parts: DataFrame
    bins: Bins
    trees: int
    width: int
    classes: int
    rows: int


def tasks(rows: DataFrame, wanted: int) -> int:
    return max(2 * rows.sparkSession.sparkContext.defaultParallelism, wanted)


def splits(rows: DataFrame, top: Tree, trees: int, slots: np.ndarray, terms: np.ndarray, shares: np.ndarray, width: int) -> pa.Table:
    """The best split of every open node (its number in ``slots``, else -1) among its ``terms``, with counts per class."""
    classes, (nodes, drawn) = len(shares), terms.shape
    each = drawn * BINS * classes
    feature, cut, left = top.feature, top.cut, top.left

    def part(node: np.ndarray, key: np.ndarray, number: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array(node, pa.int32()), pa.array(key, pa.int32()), pa.array(number, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["node", "key", "n"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread, held, gathered = Spread(width), [], 0
        totals = np.zeros(nodes * classes)

        def together() -> tuple[np.ndarray, np.ndarray]:
            keys, place = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(place, np.concatenate([n for _, n in held]), len(keys))

        for batch in spread.batches(batches):
            bag = flat(batch.column("bag"), np.uint8)[0].reshape(-1, trees)
            row, tree = np.nonzero(bag)
            slot = slots[settled(spread.cells, row, tree, feature, cut, left)]
            here = slot >= 0
            row, tree, slot = row[here], tree[here], slot[here].astype(np.int64)
            label, count = np.asarray(batch.column("label"))[row], bag[row, tree]
            totals += np.bincount(slot * classes + label, count, len(totals))
            for start in range(0, len(row), PAIRS):
                some = slice(start, start + PAIRS)
                looked = spread.cells[row[some, None], terms[slot[some]]]
                pair, term = np.nonzero(looked)
                key = ((slot[some][pair] * drawn + term) * BINS + looked[pair, term]) * classes + label[some][pair]
                held.append((key, count[some][pair]))
                gathered += len(key)
            if gathered > GATHERED:
                held = [together()]
                gathered = len(held[0][0])
                if gathered > HELD:
                    yield part(held[0][0] // each, held[0][0] % each, held[0][1])
                    held, gathered = [], 0
        if gathered:
            keys, number = together()
            yield part(keys // each, keys % each, number)
        used = np.flatnonzero(totals)
        yield part(used // classes, each + used % classes, totals[used])

    def best(table: pa.Table) -> pa.Table:
        key, number = np.asarray(table["key"]), np.asarray(table["n"])
        inside = key < each
        total = np.bincount(key[~inside] - each, number[~inside], classes)
        found = best_split(key[inside] // classes, key[inside] % classes, number[inside], total, shares) or (-1, 0, total)
        row = {"node": table["node"][0].as_py(), "term": found[0], "cut": found[1], "below": found[2], "total": total}
        types = pa.schema([("node", pa.int32()), ("term", pa.int32()), ("cut", pa.int32()), ("below", pa.list_(pa.float64())), ("total", pa.list_(pa.float64()))])
        return pa.Table.from_pydict({k: [v] for k, v in row.items()}, types)

    counted = rows.mapInArrow(task, "node int, key int, n long").repartition(min(nodes, tasks(rows, 1)), "node")
    return counted.groupBy("node").applyInArrow(best, "node int, term int, cut int, below array<double>, total array<double>").toArrow()


def pairs(rows: DataFrame, top: Tree, trees: int, wanted: np.ndarray, width: int, key: str, keep: str) -> DataFrame:
    """(node, ``keep``, count, places, bins) of the rows of every wanted node; in training as often as trees drew them."""
    feature, cut, left = top.feature, top.cut, top.left

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread = Spread(width)
        for batch in spread.batches(batches):
            bag = flat(batch.column("bag"), np.uint8)[0].reshape(batch.num_rows, -1)
            if not bag.shape[1]:
                bag = np.ones((batch.num_rows, trees), np.uint8)
            row, tree = np.nonzero(bag)
            node = settled(spread.cells, row, tree, feature, cut, left)
            here = wanted[node]
            row, tree, node = row[here], tree[here], node[here]
            for start in range(0, len(row), PAIRS):
                some = slice(start, start + PAIRS)
                taken = batch.take(pa.array(row[some]))
                columns = [pa.array(node[some], pa.int32()), taken.column(key), pa.array(bag[row[some], tree[some]], pa.int32()), taken.column("places"), taken.column("bins")]
                yield pa.RecordBatch.from_arrays(columns, names=["node", key, "n", "places", "bins"])

    return rows.mapInArrow(task, f"node int, {keep}, n int, places binary, bins binary")


def finished_parts(sent: DataFrame, levels: np.ndarray, shares: np.ndarray, width: int, drawn: int, seed: int) -> DataFrame:
    """One row per small node: its part of the tree, grown from the rows sent to it."""

    def finish(table: pa.Table) -> pa.Table:
        # The order in which rows arrive does not matter: only counts enter.
        table = table.combine_chunks()
        node = table["node"][0].as_py()
        places, sizes = flat(table["places"].chunk(0), place_type(width))
        known = np.full(width, -1, dtype=np.int32)
        known[places] = 0
        terms = np.flatnonzero(known == 0)
        known[terms] = np.arange(len(terms))
        cells = np.zeros((len(terms), len(sizes)), dtype=np.uint8)
        cells[known[places], np.repeat(np.arange(len(sizes)), sizes)] = flat(table["bins"].chunk(0), np.uint8)[0]
        draw = np.random.default_rng((seed, 1, node))
        tree = grown(cells, known, np.asarray(table["label"]), np.asarray(table["n"]), shares, int(levels[node]), draw, drawn)
        row = {"node": [node], "feature": [tree.feature.tobytes()], "cut": [tree.cut.tobytes()], "left": [tree.left.tobytes()], "votes": [tree.votes.tobytes()]}
        return pa.Table.from_pydict(row, pa.schema([("node", pa.int32()), *[(c, pa.binary()) for c in ("feature", "cut", "left", "votes")]]))

    return sent.groupBy("node").applyInArrow(finish, "node int, feature binary, cut binary, left binary, votes binary")


def fit(
    vectors: DataFrame, classes: int, width: int, trees: int, depth: int, seed: int, drawn: int | None = None
) -> Forest:
    """``vectors``: label (number of the class), class_weight (one per class) and sparse features.  ``drawn``: terms per
    node, otherwise the square root of ``width``, rounded up."""
    drawn = min(width, drawn or math.ceil(math.sqrt(width)))
    small = max(1, min(SMALL, CELLS // width))
    weights = {int(r[0]): (r[1], r[2]) for r in vectors.groupBy("label").agg(F.max("class_weight"), F.count("*")).collect()}
    shares = np.array([weights.get(c, (0.0, 0))[0] for c in range(classes)])
    total = sum(n for _, n in weights.values())
    sparse = as_rows(vectors, ("label",)).repartition(tasks(vectors, total // ROWS))
    bins = fit_bins(as_rows(vectors), width)
    rows = materialise(binned(sparse, bins, width, trees, seed, "label int"))

    feature, cut, left, level = [-1] * trees, [0] * trees, [0] * trees, [0] * trees
    ends = [np.zeros(classes, dtype=np.int64)] * trees
    # Draws come close to the number of rows; a root is only finished in a task if that surely fits.
    at_once = total <= small // 2
    rest, open_nodes = (dict.fromkeys(range(trees), total), []) if at_once else ({}, list(range(trees)))

    def top() -> Tree:
        return Tree(np.array(feature, np.int32), np.array(cut, np.uint8), np.array(left, np.int32), np.stack(ends))

    for levels in range(depth):
        if not open_nodes:
            break
        draw = np.random.default_rng((seed, 0, levels))
        terms = np.stack([drawn_terms(draw, width, drawn) for _ in open_nodes]).astype(np.int32)
        slots = np.full(len(feature), -1, dtype=np.int32)
        slots[open_nodes] = np.arange(len(open_nodes))
        best = splits(rows, top(), trees, slots, terms, shares, width).sort_by("node").to_pylist()
        following = []
        for found in best:
            node, whole = open_nodes[found["node"]], np.array(found["total"])
            ends[node] = votes(whole, shares)
            if found["term"] < 0:
                continue
            feature[node], cut[node], left[node] = int(terms[found["node"], found["term"]]), found["cut"], len(feature)
            below = np.array(found["below"])
            for part in (below, whole - below):
                child = len(feature)
                feature.append(-1), cut.append(0), left.append(0), level.append(levels + 1), ends.append(votes(part, shares))
                if levels + 1 < depth and np.count_nonzero(part) > 1:
                    if part.sum() <= small:
                        rest[child] = int(part.sum())
                    else:
                        following.append(child)
        open_nodes = following
    finished = np.zeros(len(feature), dtype=bool)
    finished[list(rest)] = True
    sent = pairs(rows, top(), trees, finished, width, "label", "label int").repartition(tasks(rows, sum(rest.values()) // FINISHED), "node")
    parts = materialise(finished_parts(sent, depth - np.array(level), shares, width, drawn, seed))
    return Forest(top(), finished, parts, bins, trees, width, classes, sum(rest.values()))


def voted(rows: DataFrame, forest: Forest, key: str) -> DataFrame:
    """(``key``, votes) of rows with sparse features and a whole number that tells them apart."""
    classes, width, trees, finished = forest.classes, forest.width, forest.trees, forest.finished
    feature, cut, left, ends = forest.top.feature, forest.top.cut, forest.top.left, forest.top.votes
    stored = materialise(binned(as_rows(rows, (key,)), forest.bins, width, 0, 0, f"{key} long"))
    schema = f"{key} long, " + ", ".join(f"v{c} long" for c in range(classes))

    def out(ids: np.ndarray, given: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *map(pa.array, np.ascontiguousarray(given.T))], names=[key, *(f"v{c}" for c in range(classes))])

    def at_the_top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread = Spread(width)
        for batch in spread.batches(batches):
            row, tree = np.divmod(np.arange(batch.num_rows * trees), trees)
            node = settled(spread.cells, row, tree, feature, cut, left)
            given = np.where(finished[node][:, None], 0, ends[node]).reshape(batch.num_rows, trees, classes).sum(1)
            yield out(np.asarray(batch.column(key)), given)

    def in_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A part comes first, then the rows that meet it."""
        at, tree = None, None
        for batch in batches:
            nodes, first = np.asarray(batch.column("node")), np.asarray(batch.column("n"))
            starts = [*np.flatnonzero(np.diff(nodes, prepend=-1)), len(nodes)]
            if starts[0] != 0:
                starts = [0, *starts]
            for start, end in zip(starts, starts[1:]):
                if nodes[start] != at:
                    at, tree = nodes[start], None
                if first[start] == 0:
                    kinds = {"places": np.int32, "bins": np.uint8, "left": np.int32, "votes": np.int64}
                    read = [flat(batch.column(c).slice(start, 1), kind)[0].copy() for c, kind in kinds.items()]
                    tree = Tree(*read[:3], read[3].reshape(-1, classes))
                    start += 1
                if tree is None:
                    continue
                used = np.unique(tree.feature[tree.feature >= 0])
                known = np.full(width, -1, dtype=np.int32)
                known[used] = np.arange(len(used))
                local = np.where(tree.feature >= 0, known[tree.feature], -1)
                for rest in sliced([batch.slice(start, end - start)], 1024):
                    places, sizes = flat(rest.column("places"), place_type(width))
                    column, cells = known[places], np.zeros((len(sizes), max(1, len(used))), dtype=np.uint8)
                    row, there = np.repeat(np.arange(len(sizes)), sizes), column >= 0
                    cells[row[there], column[there]] = flat(rest.column("bins"), np.uint8)[0][there]
                    node = settled(cells, np.arange(len(sizes)), np.zeros(len(sizes), dtype=np.int64), local, tree.cut, tree.left)
                    yield out(np.asarray(rest.column(key)), tree.votes[node])

    nothing = F.lit(None).cast("binary")
    sent = pairs(stored, forest.top, trees, finished, width, key, f"{key} long").withColumns({"left": nothing, "votes": nothing})
    parts = forest.parts.select(
        "node", F.lit(0).cast("long").alias(key), F.lit(0).alias("n"), F.col("feature").alias("places"), F.col("cut").alias("bins"), "left", "votes"
    )
    together = parts.unionByName(sent).repartition(tasks(rows, forest.rows // FINISHED), "node").sortWithinPartitions("node", "n")
    given = stored.mapInArrow(at_the_top, schema).unionByName(together.mapInArrow(in_parts, schema))
    summed_up = given.groupBy(key).agg(*[F.sum(f"v{c}").alias(f"v{c}") for c in range(classes)])
    return summed_up.select(key, F.array(*[f"v{c}" for c in range(classes)]).alias("votes"))


# The functions travel with the tasks, so executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
