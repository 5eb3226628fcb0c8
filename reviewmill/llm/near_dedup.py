"""Near-duplicate detection with bottom-k sketches of one hash function.

1. A text's set of five-word shingles is hashed; the ``K`` smallest hashes are its sketch.  Texts with equal sets
   form a class, and only its smallest id goes on.
2. Inverted lists of the retained values.  Two sets that are alike share ``shared_at_least`` retained values, so
   of each sketch only the ``size - shared_at_least + 1`` rarest values need a list (prefix filter in one global
   order: number of sketches with the value, then the value).  Values that no other sketch has use up places
   without needing a list, so most documents enter none, and a passage that thousands of different documents
   share lies behind the cut.
3. Shingles that no other candidate has bound what a set can share (``core``).  An edited copy whose core is under
   three quarters of it is like no other text and leaves the lists, and a pair is looked at only if 3/7 of both
   sizes fit into both cores.
   Pairs come from the lists in three steps, so that no group of copies is written out as pairs: (a) all pairs of
   small lists, and in large ones each member with the list's centre, the member with the fewest shingles of its own;
   links make components; (b) the members outside a list's largest component with that component; (c) with each
   other.  Pairs within a component need no comparison, so no link is lost.
   In (b) and (c) the shingles of the texts that are left are told apart by their uses there: two sets share at most
   the smaller number of common shingles (more than ``RARE`` uses) and the rare ones that both have.  A pair whose
   common shingles alone fit is compared; any other pair needs a rare one and comes from the rare shingles' lists,
   which have ``RARE`` members at most.  The bound holds for every pair, so it drops no link.
4. The union of two sketches estimates the similarity and drops pairs far below the threshold.
5. The full sets of the pairs that are left are compared exactly.
6. Components by large-star and small-star steps over the links.

The estimate and the prefix are loose: two sets of similarity 0.75 share fewer than ``FEWEST`` of ``K`` values with a
probability near 1e-10, and for sets of 48 shingles and less never; a pair that is missed costs a link only if no
third text joins the two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.shared import raw_texts, sliced
from reviewmill.session import materialise

WIDTH = 5
K = 64
FEWEST = 26
# Lists with so many members outside their largest component compare all of them at once.
SMALL_LIST = 16
# Uses up to which a shingle of the texts left over has a list of its own.
RARE = 64
# Sizes are compared in steps of five percent.
SIZE_STEP = 1.05
# Members of a list that one task joins with the list's pivots.
SALT_ROWS = 2048
MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64
)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


class Shingles:
    """Hashed shingle sets of texts; remembers the hashes of up to ``remembered`` words."""

    def __init__(self, remembered: int = 500_000):
        self.words: dict[bytes, int] = {}
        self.remembered = remembered

    def of(self, text: bytes) -> np.ndarray:
        """Sorted distinct hashes.  bytes.lower() changes A-Z only, bytes.split() cuts at the six blanks."""
        words = text.lower().split()
        if not words:
            return np.zeros(0, np.int64)
        known = self.words
        if len(known) > self.remembered:
            known.clear()
        hashes = np.empty(max(len(words), WIDTH), np.uint64)
        hashes[len(words) :] = 0
        for i, word in enumerate(words):
            value = known.get(word)
            if value is None:
                value = known[word] = xxhash.xxh64_intdigest(word)
            hashes[i] = value
        n = len(hashes) - WIDTH + 1
        sums = np.zeros(n, np.uint64)
        for j in range(WIDTH):
            sums += hashes[j : j + n] * MULTIPLIERS[j]
        return np.unique(mixed(sums).view(np.int64))


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, two sums that identify the set, sketch (null for an empty set)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in sliced(batches, 500):
            sets = [shingles.of(text) for text in raw_texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([len(each) for each in sets], pa.int64()),
                    pa.array([int(each.sum()) for each in sets], pa.int64()),
                    pa.array([int(mixed(each.view(np.uint64)).view(np.int64).sum()) for each in sets], pa.int64()),
                    pa.array([each[:K] if len(each) else None for each in sets], pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "sum_a", "sum_b", "sketch"],
            )

    schema = "doc_id bigint, n_shingles bigint, sum_a bigint, sum_b bigint, sketch array<bigint>"
    return docs.select("doc_id", "text").mapInArrow(rows, schema)


def shared_at_least(n: Column) -> Column:
    """Retained values that a set of n shingles shares with any set like it.  Up to 3/4 K shingles both sketches
    are whole sets, and three quarters of the larger one are shared; beyond, FEWEST."""
    return F.when(n <= K * 3 // 4, F.ceil(n * 3 / 4)).otherwise(FEWEST)


def size_step(n: Column) -> Column:
    return F.floor(F.log(n) / F.log(F.lit(SIZE_STEP))).cast("int")


def postings(classes: DataFrame) -> DataFrame:
    """value, node, n: the members of the inverted lists, after the prefix filter."""
    values = classes.select("node", "n_shingles", F.explode("sketch").alias("value"))
    lists = values.groupBy("value").agg(F.count("*").alias("members")).filter("members > 1")
    found = values.join(lists, "value")
    # A sketch's entries with lists, rarest first; values without a list come before them.
    per_node = found.groupBy("node", F.col("n_shingles").alias("n")).agg(
        F.sort_array(F.collect_list(F.struct("members", "value"))).alias("entries")
    )
    size = F.least(F.col("n"), F.lit(K))
    places = F.size("entries") - shared_at_least(F.col("n")) + 1
    return (
        per_node.filter(places > 0)
        .select("node", "n", F.explode(F.slice("entries", F.lit(1), places.cast("int"))).alias("entry"))
        .select(F.col("entry.value").alias("value"), "node", "n")
    )


def shingle_rows(texts: DataFrame) -> DataFrame:
    """node, shingle: the full sets of the texts, a row each."""

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in sliced(batches, 100):
            sets = [shingles.of(text) for text in raw_texts(batch.column("text"))]
            owners = np.repeat(np.arange(len(sets)), [len(each) for each in sets])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(owners)), pa.array(np.concatenate([*sets, np.zeros(0, np.int64)]))],
                names=["node", "shingle"],
            )

    return texts.mapInArrow(exploded, "node bigint, shingle bigint")


def repeated_ids(texts: DataFrame) -> DataFrame:
    """node: ids with several texts, whose shingles can't be told from each other's."""
    return texts.groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("node"))


def alone(texts: DataFrame) -> DataFrame:
    """node, alone: shingles that no other candidate has.  0 (no row) for an id with several texts."""
    once = shingle_rows(texts).groupBy("shingle").agg(F.count("*").alias("uses"), F.min("node").alias("node"))
    own = once.filter("uses = 1").groupBy("node").agg(F.count("*").alias("alone"))
    return own.join(repeated_ids(texts), "node", "left_anti")


def rare_shingles(texts: DataFrame) -> DataFrame:
    """node, shingle: those that at least two and at most ``RARE`` of the texts have."""
    rows = materialise(shingle_rows(texts))
    uses = rows.groupBy("shingle").agg(F.count("*").alias("uses")).filter(F.col("uses").between(2, RARE))
    return rows.join(uses, "shingle").select("node", "shingle")


def common_sizes(nodes: DataFrame, rare: DataFrame, texts: DataFrame) -> DataFrame:
    """Adds ``common``: shingles in ``core`` that are not rare, or ``core`` for an id with several texts."""
    counts = rare.groupBy("node").agg(F.count("*").alias("rare")).join(repeated_ids(texts), "node", "left_anti")
    return nodes.join(counts, "node", "left").withColumn("common", F.col("core") - F.coalesce("rare", F.lit(0))).drop("rare")


def rare_pairs(nodes: DataFrame, rare: DataFrame) -> DataFrame:
    """Distinct pairs a < b that share rare shingles, enough of them for similarity 0.75 if all common ones of the smaller
    set are shared too.  ``nodes``: node, n, common, comp, apart; pairs of different components, one of them apart."""
    held = rare.join(nodes.select("node", "n", "common", "comp", "apart"), "node")
    other = held.select(
        "shingle", F.col("node").alias("pivot"), F.col("n").alias("m"), F.col("common").alias("most"),
        F.col("comp").alias("other"), F.col("apart").alias("also"),
    )
    # A pair of two texts that are both apart is met once.
    met = held.filter("apart").join(other, "shingle").filter("comp != other and (not also or node < pivot)")
    shared = met.groupBy("node", "pivot", "n", "m", "common", "most").agg(F.count("*").alias("shared"))
    enough = shared.filter(7 * (F.least("common", "most") + F.col("shared")) >= 3 * (F.col("n") + F.col("m")))
    return enough.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()


def open_lists(members: DataFrame) -> DataFrame:
    """value, top, all_members, others: lists whose members are not yet one component, with their largest
    component (null if all are single) and the number of members outside it."""
    parts = members.groupBy("value", "comp").agg(F.count("*").alias("rows"))
    lists = parts.groupBy("value").agg(
        F.sum("rows").alias("all_members"),
        F.count("*").alias("comps"),
        F.max(F.struct("rows", "comp")).alias("largest"),
    )
    single = F.col("largest.rows") == 1
    return lists.filter("comps > 1").select(
        "value", "all_members",
        F.when(~single, F.col("largest.comp")).alias("top"),
        (F.col("all_members") - F.when(single, 0).otherwise(F.col("largest.rows"))).alias("others"),
    )


MEMBER = ["value", "node", "n", "core"]


def outside(live: DataFrame) -> DataFrame:
    """Members outside the largest component of their list; all if it has no component."""
    return live.filter(F.col("top").isNull() | (F.col("comp") != F.col("top")))


def centres(live: DataFrame) -> DataFrame:
    """The member of each large list with the smallest share of shingles of its own.  No list is gathered or sorted."""
    order = F.struct((1 - F.col("core") / F.col("n")).alias("own"), F.xxhash64("node").alias("hashed"), "node", "n", "core", "comp", "all_members")
    best = live.filter(F.col("others") > SMALL_LIST).groupBy("value").agg(F.min(order).alias("best"))
    return best.select("value", *[f"best.{name}" for name in ("node", "n", "core", "comp", "all_members")])


def fits(n: Column, one: Column, m: Column, two: Column) -> Column:
    """Whether sizes n, m and cores allow similarity 0.75: 3/7 of both sizes shared."""
    return 7 * F.least(one, two) >= 3 * (n + m)


def centre_pairs(live: DataFrame) -> DataFrame:
    """Distinct pairs a < b of a large list's centre and its other members."""
    centre = centres(live).select(
        "value", F.col("node").alias("pivot"), F.col("n").alias("m"), F.col("core").alias("most"), F.col("comp").alias("other")
    )
    met = live.join(centre, "value").filter((F.col("comp") != F.col("other")) & fits(F.col("n"), F.col("core"), F.col("m"), F.col("most")))
    return met.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()


def with_own_lists(members: DataFrame) -> DataFrame:
    """Adds ``lists``: the values under which the node stands here, K at most."""
    own = members.groupBy("node").agg(F.sort_array(F.collect_set("value")).alias("lists"))
    return members.join(own, "node")


def fitting_pairs(members: DataFrame, pivots: DataFrame, key: str, first_only: bool = False) -> DataFrame:
    """Distinct pairs a < b of a pivot and a member with the same ``key``, in different components, whose sizes and
    cores allow similarity 0.75, that is 3/7 of both sizes shared.  A pivot meets only the steps of sizes that its own
    size and core leave.  Members of a large key are dealt out by a salt, as many as its size (``all_members``, with
    both sides) asks for, and only the pivots are repeated.  ``first_only``: a pair comes out of the first list that both
    are in (column ``lists``), not of each."""
    lists = ["lists"] if first_only else []
    salts = F.ceil(F.col("all_members") / SALT_ROWS).cast("int")
    left = members.select(
        key, size_step(F.col("n")).alias("step"), F.pmod(F.xxhash64("node", F.lit(1)), salts).cast("int").alias("salt"),
        "node", "n", "core", "comp", *lists,
    )
    largest = F.least(F.col("n") * 4 / 3, F.col("core") * 7 / 3 - F.col("n")) + 0.5
    smallest = F.col("n") * 3 / 4 - 0.5
    right = (
        pivots.filter(largest >= smallest)
        .select("*", F.explode(F.sequence(size_step(F.greatest(smallest, F.lit(1.0))), size_step(largest))).alias("step"))
        .select(
            key, "step", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.col("node").alias("pivot"),
            F.col("n").alias("m"), F.col("core").alias("most"), F.col("comp").alias("other"),
            *[F.col(name).alias("their_lists") for name in lists],
        )
    )
    met = left.join(right, [key, "step", "salt"]).filter((F.col("comp") != F.col("other")) & fits(F.col("n"), F.col("core"), F.col("m"), F.col("most")))
    if first_only:
        met = met.filter(F.get(F.array_intersect("lists", "their_lists"), 0) == F.col(key))
    return met.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b")).distinct()


def passes_estimate(a: Column, b: Column) -> Column:
    """Union sketch: of the K smallest values of both, the share that both have.  Exact if both sets are whole."""
    union = F.slice(F.sort_array(F.array_union(a, b)), 1, K)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    whole = (F.size(a) < K) & (F.size(b) < K) & (F.size(F.array_union(a, b)) <= K)
    return F.when(whole, 100 * both >= 75 * F.size(union)).otherwise(both * K >= F.size(union) * FEWEST)


def estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    sketches = classes.select("node", "sketch")
    return (
        pairs.join(sketches.toDF("a", "sketch_a"), "a")
        .join(sketches.toDF("b", "sketch_b"), "b")
        .filter(passes_estimate(F.col("sketch_a"), F.col("sketch_b")))
        .select("a", "b")
        .distinct()
    )


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full shingle sets have a Jaccard similarity of 0.75 or more."""
    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in sliced(batches, 500):
            keep = []
            for left, right in zip(raw_texts(batch.column("text_a")), raw_texts(batch.column("text_b")), strict=True):
                one, two = shingles.of(left), shingles.of(right)
                shared = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * shared >= 75 * (len(one) + len(two) - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(compared, "a bigint, b bigint")


def large_star(edges: DataFrame) -> DataFrame:
    """Connects every larger neighbour of a node with the node's smallest neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("least"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Connects every smaller neighbour of a node, and the node, with the smallest one."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("least"))
    moved = down.join(least, "u").filter("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return moved.unionByName(least.select("u", F.col("least").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, comp (its smallest reachable node), for nodes with links (u, v).  Done when the edges are stars: every
    node has one parent, and no parent has one."""
    edges = materialise(links.filter("u != v").distinct())
    while True:
        edges = materialise(small_star(materialise(large_star(edges))))
        roles = edges.select("u", F.col("v").alias("parent")).unionByName(
            edges.select(F.col("v").alias("u"), F.lit(None).cast("long").alias("parent"))
        )
        parents = F.count("parent")
        unfinished = roles.groupBy("u").agg(
            ((F.min("parent") != F.max("parent")) | ((parents > 0) & (F.count("*") > parents))).alias("moves")
        )
        if unfinished.filter("moves").isEmpty():
            return edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))


def linked(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """node, comp for the classes that are linked with another."""
    lists = materialise(postings(classes))
    entered = lists.select(F.col("node").alias("doc_id")).distinct()
    texts = materialise(docs.select("doc_id", "text").join(entered, "doc_id", "left_semi"))
    core = F.col("n") - F.coalesce("alone", F.lit(0))
    lists = materialise(lists.join(alone(texts), "node", "left").withColumn("core", core).filter(4 * core >= 3 * F.col("n")).select(*MEMBER))
    links = docs.sparkSession.createDataFrame([], "u bigint, v bigint")
    comps = links.toDF("node", "comp")

    def joined(pairs: DataFrame) -> DataFrame:
        nonlocal links
        new = materialise(confirmed(estimated(materialise(pairs), classes), texts).toDF("u", "v"))
        if new.isEmpty():
            return comps
        links = new.unionByName(comps.toDF("u", "v"))
        return components(links)

    def current() -> DataFrame:
        members = lists.join(comps, "node", "left").select(*MEMBER, F.coalesce("comp", "node").alias("comp"))
        return materialise(members.join(open_lists(members), "value"))

    live = current()
    small = live.filter(F.col("others") <= SMALL_LIST)
    comps = joined(fitting_pairs(small, small, "value").union(centre_pairs(live)).distinct())

    live = current().filter(F.col("all_members") > SMALL_LIST)
    apart = materialise(outside(live))
    if apart.isEmpty():
        return comps
    against = apart.filter("top is not null").select("node", "n", "core", "comp", "top").distinct()
    sizes = comps.groupBy("comp").agg(F.count("*").alias("all_members")).withColumnRenamed("comp", "top")
    # Every member, also the smallest id, for which components() has no row.
    within = materialise(
        lists.select("node", "n", "core").distinct().join(comps, "node", "left")
        .withColumn("comp", F.coalesce("comp", "node")).withColumn("top", F.col("comp"))
        .join(against.select("top").distinct(), "top", "left_semi").join(sizes, "top")
    )

    involved = apart.select("node", "n", "core", "comp", F.lit(True).alias("apart")).unionByName(
        within.select("node", "n", "core", "comp", F.lit(False).alias("apart"))
    )
    involved = materialise(involved.groupBy("node", "n", "core", "comp").agg(F.max("apart").alias("apart")))
    left_over = texts.join(involved.select(F.col("node").alias("doc_id")).distinct(), "doc_id", "left_semi")
    rare = materialise(rare_shingles(left_over))
    bounds = materialise(common_sizes(involved, rare, left_over))

    def bounded(members: DataFrame) -> DataFrame:
        """With the common shingles in place of ``core``."""
        common = bounds.select("node", "n", F.col("common").alias("_common")).distinct()
        return members.join(common, ["node", "n"]).withColumn("core", F.col("_common")).drop("_common")

    comps = joined(
        fitting_pairs(bounded(within), bounded(against.join(sizes, "top")), "top").union(rare_pairs(bounds, rare)).distinct()
    )

    again = bounded(apart).drop("comp").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    again = with_own_lists(again)
    return joined(fitting_pairs(again, again, "value", first_only=True))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    ``docs`` needs doc_id and text; other columns are ignored.  Null, empty and blank texts have no shingles and
    are linked with nothing.  Rows that repeat an id count as one document with several texts; kept is true for
    all rows that carry the component's smallest id.  A row without an id belongs to the component of equal or
    similar texts that have one and is then not kept; otherwise its component is null and it is kept.
    """
    rows = materialise(sketched(docs))
    key = ["n_shingles", "sum_a", "sum_b"]
    classes = materialise(
        rows.filter("n_shingles > 0 and doc_id is not null")
        .groupBy(*key)
        .agg(F.min("doc_id").alias("node"), F.first("sketch").alias("sketch"))
    )
    comps = linked(docs, classes)
    named = materialise(
        classes.join(comps, "node", "left").select(*key, F.coalesce("comp", "node").alias("component_id"))
    )
    some = rows.filter("n_shingles > 0").join(named, key, "left").select("doc_id", "n_shingles", "component_id")
    none = rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return some.unionByName(none).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the smallest id of their component, with all their columns; of rows that repeat an
    id one stays.  Rows without an id stay, as nothing names them in a group."""
    found = materialise(near_duplicates(docs).filter("doc_id is not null"))
    gone = found.filter("not kept").select("doc_id").distinct()
    rest = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    repeated = materialise(found.groupBy("doc_id").count().filter("count > 1").select("doc_id"))
    if repeated.isEmpty():
        return rest
    once = rest.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*docs.columns)
    return rest.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(once)
