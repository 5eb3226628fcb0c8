"""Mixing sources to target weights with Pareto order sampling.

Targets: the sources in code point order get the weights in turn, and share all words by weight; a target
above ``MOST_COPIES`` times its source stops there and the excess is shared again.  Copies: a document may
expect ``least(MOST_COPIES, rate * v)`` copies, where v grows with the number of digits of its binary size
(longer documents are a little likelier) and the source's rate makes the expected words equal the target.
The whole part is certain.  The fraction p is an inclusion probability: documents are ranked by the Pareto
order sampling ratio, odds of a random number over odds of p, and taken in that order until the words that
the certain copies leave open are reached; the document at the border is taken if that comes nearer.
The sample's size is thus fixed in words, to within half the document at the border.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.llm.shared import id_text, unit_draw, word_count
from reviewmill.session import materialise

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = "mix-1"
# Cells of the Pareto ranking per source: no task ranks more than a 4096th of a source's documents.
CELLS = 4096
# Sources whose decisions are sent to every task.
MOST_BROADCAST = 100_000


def ranked_sources(sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """source, source_size, weight.  Ranks come from sorted ranges and their counts, not from one task."""
    ranges = materialise(
        sizes.repartitionByRange(sizes.sparkSession.sparkContext.defaultParallelism, F.col("source").asc_nulls_last())
        .withColumn("part", F.spark_partition_id())
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    offsets = ranges.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1
    in_turn = F.array(*[F.lit(w).cast("long") for w in weights])
    return ranges.withColumn("place", place).join(offsets, "part").select(
        "source", "source_size", F.element_at(in_turn, (F.pmod(F.col("place") + F.col("before"), F.lit(len(weights))) + 1).cast("int")).alias("weight")
    )


def targets(sources: DataFrame, most: int) -> DataFrame:
    """Adds ``target``.  Each round reads one row of sums: the words still open and the weights that share them."""
    cap = (F.col("source_size") * most).cast("double")
    level, stopped = 0.0, -1
    while True:
        full = cap < F.col("weight") * F.lit(level)
        sums = sources.agg(
            F.sum("source_size").alias("all_words"),
            F.sum(F.when(full, F.col("source_size") * most)).alias("given"),
            F.sum(F.when(~full, F.col("weight"))).alias("open_weight"),
            F.count_if(full).alias("stopped"),
        ).first()
        if sums.stopped == stopped or not sums.open_weight:
            return sources.withColumn("target", F.when(full, cap).otherwise(F.col("weight") * F.lit(level)))
        stopped = sums.stopped
        level = float(sums.all_words - (sums.given or 0)) / float(sums.open_weight)


def rates(classes: DataFrame, most: int) -> DataFrame:
    """source, rate, from rows (source, target, v, words), a row per binary length: the rate at which
    least(most, rate * v) copies of the words make the target.  Classes stop at ``most`` from the largest v down."""
    down = Window.partitionBy("source").orderBy(F.desc("v"))
    stopped = F.coalesce(F.sum("words").over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    moving = F.sum(F.col("v") * F.col("words")).over(down.rowsBetween(0, Window.unboundedFollowing))
    tried = classes.filter("words > 0").select(
        "source", "v", ((F.col("target") - (stopped * most).cast("double")) / moving.cast("double")).alias("rate")
    )
    fits = F.col("rate") * F.col("v") <= most
    return tried.groupBy("source").agg(
        F.coalesce(F.max_by(F.when(fits, F.col("rate")), F.when(fits, F.col("v"))), F.lit(float(most)) / F.min("v")).alias("rate")
    )


def attached(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    """Left join on source, null equal to null.  Left to the planner: Spark broadcasts the table of sources
    if it measures it as small, and otherwise splits the rows of a hot source."""
    right = per_source.withColumnRenamed("source", "_source")
    return rows.join(right, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def with_length_class(rows: DataFrame) -> DataFrame:
    """Adds v, which grows with the digits of the binary size."""
    bits = F.when(F.col("size") > 0, F.length(F.bin("size"))).otherwise(0)
    return rows.withColumn("v", (bits + 8).cast("long"))


def with_order(rows: DataFrame, most: int, seed: str) -> DataFrame:
    """Adds certain (whole copies) and order: the Pareto ratio q as q / (1 + q), null where nothing is drawn."""
    expected = F.least(F.lit(float(most)), F.coalesce(F.col("rate"), F.lit(0.0)) * F.col("v"))
    key = F.concat(id_text(F.col("doc_id")), F.lit(":"), F.col("size").cast("string"), F.lit(f":{seed}"))
    ratio = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    return (
        rows.withColumn("expected", expected)
        .withColumn("certain", F.floor("expected").cast("long"))
        .withColumn("p", F.when(F.col("size") > 0, F.col("expected") - F.col("certain")).otherwise(0.0))
        .withColumn("u", unit_draw(key))
        .withColumn("order", F.when(F.col("p") > 0, ratio / (1 + ratio)))
        .withColumn("cell", F.floor(F.col("order") * CELLS).cast("int"))
        .drop("expected", "p", "u")
    )


def border(ranked: DataFrame) -> DataFrame:
    """source, border, last: the cell in which the sample ends (``CELLS`` if it takes all) and the last document
    taken there (null if none).  Only the documents of a source's border cell meet in one task."""
    cells = ranked.groupBy("source", "cell").agg(
        F.sum(F.when(F.col("cell").isNotNull(), F.col("size"))).alias("words"),
        F.sum(F.col("certain") * F.col("size")).alias("given"),
        F.first("target").alias("target"),
    )
    by_source = Window.partitionBy("source")
    before = F.sum("words").over(by_source.orderBy(F.asc_nulls_first("cell")).rowsBetween(Window.unboundedPreceding, -1))
    cut = cells.select(
        "source", "cell", "words",
        (F.col("target") - F.sum("given").over(by_source).cast("double")).alias("open"),
        F.coalesce(before, F.lit(0)).alias("before"),
    )
    ends = F.col("cell").isNotNull() & (F.col("before") + F.col("words") > F.col("open"))
    found = materialise(
        cut.groupBy("source").agg(
            F.first("open").alias("open"),
            F.coalesce(F.min(F.when(ends, F.col("cell"))), F.lit(CELLS)).alias("border"),
            F.coalesce(F.min_by(F.when(ends, F.col("before")), F.when(ends, F.col("cell"))), F.lit(0)).alias("before"),
        )
    )
    so_far = by_source.orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edge = attached(ranked, found).filter(F.col("cell") == F.col("border"))
    taken = edge.withColumn("sum", F.sum("size").over(so_far) + F.col("before")).filter(
        2 * F.col("sum") - F.col("size") <= 2 * F.col("open")
    )
    last = taken.groupBy("source").agg(F.max(F.struct("order", "doc_id", "size")).alias("last"))
    return attached(found.select("source", "border"), last)


def checked(per_source: DataFrame) -> DataFrame:
    """Marked for broadcast if it has few enough sources, so that the documents stay where they are; beyond that a
    stored table, whose join Spark shuffles and splits by skew."""
    return F.broadcast(per_source) if per_source.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST else per_source


def plan(docs: DataFrame, weights: tuple[int, ...], most: int, seed: str) -> tuple[DataFrame, DataFrame]:
    """The sized documents, and a row per source: source_size, target, rate, border, last."""
    sized = materialise(with_length_class(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))))
    classes = materialise(sized.groupBy("source", "v").agg(F.sum("size").alias("words")))
    sizes = classes.groupBy("source").agg(F.sum("words").alias("source_size"))
    aimed = materialise(targets(materialise(ranked_sources(sizes, weights)), most))
    rated = materialise(attached(aimed.drop("weight"), rates(attached(classes, aimed.select("source", "target")), most)))
    ranked = materialise(with_order(attached(sized, rated), most, seed))
    return sized, checked(materialise(attached(rated, border(ranked))))


def with_copies(rows: DataFrame, per_source: DataFrame, most: int, seed: str) -> DataFrame:
    """Adds ``copies`` to rows with doc_id, source, size and v."""
    here = F.struct("order", "doc_id", "size")
    drawn = (F.col("cell") < F.col("border")) | ((F.col("cell") == F.col("border")) & (here <= F.col("last")))
    planned = with_order(attached(rows, per_source), most, seed)
    return planned.withColumn("copies", F.col("certain") + F.coalesce(drawn, F.lit(False)).cast("long"))


def copies(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken (= copies * size).

    ``docs`` needs doc_id, source and text; other columns are ignored.  A null text has size 0 and adds no words, a
    null source is a source of its own, a null id draws as "null"; rows that agree in id and size are taken alike,
    also at the border.  No rows in, no rows out.
    """
    sized, per_source = plan(docs, weights, most, seed)
    return with_copies(sized, per_source, most, seed).select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; documents without words never.  The decisions need
    a row per source only; up to ``MOST_BROADCAST`` sources no text is shuffled for them."""
    _, per_source = plan(docs, weights, most, seed)
    narrow = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source", word_count(F.col("text")).alias("size"))
    chosen = with_copies(with_length_class(narrow), per_source, most, seed).filter("copies > 0 and size > 0")
    return chosen.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
