"""Hard negatives by segment summaries.

A vector's components, as integers, are cut into segments of ``FINEST``; a row keeps each segment's mean and deviation.
Within a segment of length L the product of two vectors is L times the product of their means plus a rest of at
most L times the product of their deviations.  Summed over the segments that bounds the score of a pair from
both sides, without its components.  Coarser segments (``LEVELS``) are computed from finer ones, so a pair is first
bounded by a few numbers and, while the bounds don't decide, by more; what is left is scored exactly.

1. Rows are dealt into groups, anchors into blocks; a cell is a group and a block.  A cell holds ``GROUP`` rows and
   ``ANCHORS`` anchors at most, whatever the size of the table and whatever a label's share.
2. Positives: in a cell, the fifth largest lower bound of an anchor's rows of the same label discards rows whose
   upper bound is below it; the best five of what is left go on, and the best five over the cells are the positives.
3. Negatives: the positives' scores give each anchor windows of scores; rows of other labels whose bounds lie
   outside all windows are discarded, those between are scored, and the best three of each window go on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.session import materialise

EVERY = 50
RELABELLED = 7
LABELS = 10
POSITIVES = 5
NEGATIVES = 3
# A negative's score in hundredths of the positive's.
LEAST, MOST = 50, 95
FINEST = 4
# Segments of the finest length that a level joins, coarse first.
LEVELS = (4, 1)
GROUP = 32_768
ANCHORS = 2048
# Anchors of a cell that are compared with its rows at a time.
AT_ONCE = 64
# Above this share of undecided pairs a matrix product of all is cheaper than picking them.
DENSE = 0.2
# Components of this size and more are too large for exact sums in 64 bits.
TOO_LARGE = float(1 << 20)
NO_ID = (1 << 63) - 1


def usable(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """row, vec_id, label, v: the rows that take part, with integer components padded to the longest vector."""
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    # Not a number counts as larger than any number here.
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double")) < TOO_LARGE, F.lit(False)))
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % RELABELLED == 0, (label + 1) % LABELS).otherwise(label)
    return materialise(
        vectors.filter("label is not null and embedding is not null").filter(finite).select(
            F.monotonically_increasing_id().alias("row"),
            F.coalesce(F.col("vec_id").cast("long"), F.lit(NO_ID)).alias("vec_id"),
            label.alias("label"),
            whole.alias("v"),
        )
    )


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of numbers as rows of a matrix, padded with zeros."""
    lists = column.combine_chunks()
    lengths = np.asarray(lists.value_lengths().fill_null(0), dtype=np.int64)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = np.asarray(lists.flatten())
    return out


def summaries(vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Per level: means and deviations of the segments, and their length.  Coarser levels come from the finest."""
    rows, width = vectors.shape
    parts = vectors.reshape(rows, width // FINEST, FINEST)
    fine = parts.mean(2)
    spread = ((parts - fine[:, :, None]) ** 2).mean(2)
    levels = []
    for joined in LEVELS:
        count = -(-fine.shape[1] // joined)
        means, spreads = (np.pad(x, ((0, 0), (0, count * joined - x.shape[1]))).reshape(rows, count, joined) for x in (fine, spread))
        mean = means.mean(2)
        levels.append((mean, np.sqrt((spreads + (means - mean[:, :, None]) ** 2).mean(2)), joined * FINEST))
    return levels


class Bounded:
    """Scores between a few anchors and the rows of a cell: bounds by level, exact scores of chosen pairs."""

    def __init__(self, anchors: np.ndarray, rows: np.ndarray):
        self.anchors, self.rows = anchors, rows
        self.levels = list(zip(summaries(anchors), summaries(rows), strict=True))

    def bounds(self, level: int, at: np.ndarray, undecided: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds, widened against rounding; outside ``undecided`` they may be anything."""
        (mean, deviation, length), (means, deviations, _) = self.levels[level]
        if undecided.mean() > DENSE:
            centre, reach = length * (mean[at] @ means.T), length * (deviation[at] @ deviations.T)
        else:
            centre, reach = np.zeros(undecided.shape), np.zeros(undecided.shape)
            i, j = np.nonzero(undecided)
            centre[i, j] = length * np.einsum("nd,nd->n", mean[at[i]], means[j])
            reach[i, j] = length * np.einsum("nd,nd->n", deviation[at[i]], deviations[j])
        reach += 1 + 1e-9 * (np.abs(centre) + reach)
        return centre - reach, centre + reach

    def scores(self, at: np.ndarray, undecided: np.ndarray) -> np.ndarray:
        """Exact scores of the undecided pairs; the least number elsewhere."""
        out = np.full(undecided.shape, np.iinfo(np.int64).min)
        whole = np.float64 if self.exact() else np.int64
        if undecided.mean() > DENSE:
            found = self.anchors[at].astype(whole) @ self.rows.T.astype(whole)
            out[undecided] = found[undecided].astype(np.int64)
        else:
            i, j = np.nonzero(undecided)
            for start in range(0, len(i), 1 << 16):
                part = slice(start, start + (1 << 16))
                found = np.einsum("nd,nd->n", self.anchors[at[i[part]]].astype(whole), self.rows[j[part]].astype(whole))
                out[i[part], j[part]] = found.astype(np.int64)
        return out

    def exact(self) -> bool:
        """Whether sums of products stay below 2^53, where doubles are whole numbers."""
        largest = [np.abs(x).max(initial=0) for x in (self.anchors, self.rows)]
        return largest[0] * largest[1] * self.anchors.shape[1] < 2.0**53


def best_positives(pairs: Bounded, at: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact scores of the rows that can be among the best ``POSITIVES`` of an anchor."""
    for level in range(len(LEVELS)):
        low, high = pairs.bounds(level, at, candidates)
        low[~candidates] = -np.inf
        if low.shape[1] > POSITIVES:
            candidates = candidates & (high >= np.partition(low, -POSITIVES, 1)[:, [-POSITIVES]])
    return pairs.scores(at, candidates)


def in_windows(pairs: Bounded, at: np.ndarray, candidates: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Exact scores of the rows whose bounds meet the anchor's range of windows."""
    for level in range(len(LEVELS)):
        low, high = pairs.bounds(level, at, candidates)
        candidates = candidates & (high >= least[:, None]) & (low <= most[:, None])
    return pairs.scores(at, candidates)


def dealt(rows: DataFrame, anchors: DataFrame, blocks: int, groups: int):
    """Both sides in cells (group, block): rows repeated per block of anchors, anchors per group of rows."""
    left = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])  # columns of its own: both come from one table
    left = left.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    left = left.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = rows.withColumn("group", F.pmod(F.col("row"), F.lit(groups)).cast("int"))
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return left.groupBy("group", "block").cogroup(right.groupBy("group", "block"))


def positives_of(rows: DataFrame, anchors: DataFrame, width: int, blocks: int, groups: int) -> DataFrame:
    """anchor_row, positive_row, positive_id, positive_score: per anchor the best other rows of its label."""
    schema = "anchor_row bigint, positive_row bigint, positive_id bigint, positive_score bigint"

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros((0, 4), np.int64)]
        right = right.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        theirs, ours = np.asarray(right["label"]), np.asarray(left["label"])
        row, ids, anchor_row = np.asarray(right["row"]), np.asarray(right["vec_id"]), np.asarray(left["row"])
        a, b = matrix(left["v"], width), matrix(right["v"], width)
        for label in np.intersect1d(ours, theirs):
            mine, here = np.flatnonzero(ours == label), np.flatnonzero(theirs == label)
            pairs = Bounded(a[mine], b[here])
            for start in range(0, len(mine), AT_ONCE):
                at = np.arange(start, min(start + AT_ONCE, len(mine)))
                others = anchor_row[mine[at]][:, None] != row[here]
                scores = best_positives(pairs, at, others)
                for k, i in enumerate(mine[at]):
                    found = np.flatnonzero(scores[k] > np.iinfo(np.int64).min)
                    # Rows stand by id, so a stable sort breaks ties by it.
                    found = found[np.argsort(-scores[k][found], kind="stable")[:POSITIVES]]
                    n = len(found)
                    out.append(np.stack([np.full(n, anchor_row[i]), row[here[found]], ids[here[found]], scores[k][found]], 1))
        return pa.table(list(np.concatenate(out).T), names=["anchor_row", "positive_row", "positive_id", "positive_score"])

    found = dealt(rows, anchors, blocks, groups).applyInArrow(cell, schema)
    order = Window.partitionBy("anchor_row").orderBy(F.desc("positive_score"), "positive_id", "positive_row")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= POSITIVES)


def negatives_of(rows: DataFrame, asked: DataFrame, width: int, blocks: int, groups: int) -> DataFrame:
    """anchor_row, positive_score, negative_id, negative_score: per anchor and positive score the best negatives.
    ``asked`` are anchors with ``scores``, the distinct scores of their positives."""
    schema = "anchor_row bigint, positive_score bigint, negative_row bigint, negative_id bigint, negative_score bigint"

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [np.zeros((0, 5), np.int64)]
        right = right.sort_by([("vec_id", "ascending"), ("row", "ascending")])
        theirs, ours = np.asarray(right["label"]), np.asarray(left["label"])
        row, ids, anchor_row = np.asarray(right["row"]), np.asarray(right["vec_id"]), np.asarray(left["row"])
        asked_scores = left["scores"].to_pylist()
        pairs = Bounded(matrix(left["v"], width), matrix(right["v"], width))
        # Integers: ceil(LEAST * p / 100) to floor(MOST * p / 100).
        windows = [[(-(-LEAST * p // 100), MOST * p // 100, p) for p in scores] for scores in asked_scores]
        least = np.array([min((low for low, _, _ in each), default=0) for each in windows], float)
        most = np.array([max((high for _, high, _ in each), default=-1) for each in windows], float)
        for start in range(0, len(ours) if len(theirs) else 0, AT_ONCE):
            at = np.arange(start, min(start + AT_ONCE, len(ours)))
            scores = in_windows(pairs, at, ours[at][:, None] != theirs, least[at], most[at])
            for k, i in enumerate(at):
                found = np.flatnonzero((scores[k] >= least[i]) & (scores[k] <= most[i]) & (scores[k] > np.iinfo(np.int64).min))
                found = found[np.argsort(-scores[k][found], kind="stable")]
                values = scores[k][found]
                for low, high, p in windows[i]:
                    chosen = found[(values >= low) & (values <= high)][:NEGATIVES]
                    n = len(chosen)
                    out.append(np.stack([np.full(n, anchor_row[i]), np.full(n, p), row[chosen], ids[chosen], scores[k][chosen]], 1))
        names = ["anchor_row", "positive_score", "negative_row", "negative_id", "negative_score"]
        return pa.table(list(np.concatenate(out).T), names=names)

    found = dealt(rows, asked, blocks, groups).applyInArrow(cell, schema)
    order = Window.partitionBy("anchor_row", "positive_score").orderBy(F.desc("negative_score"), "negative_id", "negative_row")
    return found.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= NEGATIVES)


def mine(vectors: DataFrame, every: int = EVERY) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` needs vec_id, embedding and label; other columns are ignored.  Rows with a null label, a null vector or
    a null or non-finite component take no part, nor do those with a component of 2^20 and more, whose scores need
    more than 64 bits.  Of vectors of different lengths the shorter one counts as having zeros.  A row without an id
    is no anchor and comes last among equal scores.  Rows that repeat an id are rows of their own.  Anchors without
    positives and positives without negatives give no row; an empty table gives none.
    """
    rows = usable(vectors)
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width"), F.count_if((F.col("vec_id") % every == 0) & (F.col("vec_id") != NO_ID)).alias("anchors")).first()
    width = max(1, -(-(facts["width"] or 0) // FINEST)) * FINEST
    blocks = max(1, -(-facts["anchors"] // ANCHORS))
    # At least as many cells as a shuffle has partitions.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(-(-facts["n"] // GROUP), -(-tasks // blocks), 1)
    anchors = rows.filter((F.col("vec_id") % every == 0) & (F.col("vec_id") != NO_ID))
    positives = materialise(positives_of(rows, anchors, width, blocks, groups))
    asked = anchors.join(positives.groupBy(F.col("anchor_row").alias("row")).agg(F.collect_set("positive_score").alias("scores")), "row")
    negatives = negatives_of(rows, asked, width, blocks, groups)
    ids = anchors.select(F.col("row").alias("anchor_row"), F.col("vec_id").alias("anchor_id"))
    known = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return (
        positives.join(negatives, ["anchor_row", "positive_score"])
        .join(ids, "anchor_row")
        .select("anchor_id", known("positive_id"), "rank", known("negative_id"), "positive_score", "negative_score")
    )
