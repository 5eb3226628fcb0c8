"""Reproducible samples and splits.

The order of rows is the md5 of (id, seed), so it is the same on every run and every cluster.
Nothing is ever sorted as a whole.  A sample of n rows, or the border between two splits, is the
n-th smallest hash of its stratum, and that one value is found in two narrow passes over
(stratum, id): count rows per hash prefix, then rank only the rows of the one prefix the border
falls in (1/65,536 of the data).  The wide table is then filtered against the border, row by row,
without a shuffle.

Rows with equal or null ids are told apart by their place in the source (``source_file``, ``source_row_id``,
``row_key``, where the table has them) or else by a hash of their other columns, so samples have the
exact size; only rows that agree in everything stay together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill import settings

PREFIX = 4  # hex digits, 65,536 buckets


#: Strata whose borders (some 100 bytes each) are handed to every task.
FEW_STRATA = 100_000

PLACES = ("source_file", "source_row_id", "row_key")


def hash_key(id_column: str, seed: int = settings.SEED) -> Column:
    return F.md5(F.concat(F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.lit(f":{seed}")))


def row_key(df: DataFrame, id_column: str, seed: int = settings.SEED) -> Column:
    """:func:`hash_key` with a tie-break behind it."""
    others = [c for c in df.columns if c != id_column]
    ties = [c for c in PLACES if c in others] or others
    if not ties:
        return hash_key(id_column, seed)
    return F.concat(hash_key(id_column, seed), F.hex(F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in ties])))


def borders(narrow: DataFrame, targets: DataFrame, strata: Sequence[str]) -> DataFrame:
    """For each (stratum, cut, wanted) in ``targets``: the ``wanted``-th smallest ``_key``.

    ``narrow`` holds the strata and ``_key``.  Both small sides are bounded by strata x cuts,
    whatever the number of rows.
    """
    strata = list(strata)
    keyed = narrow.withColumn("_prefix", F.substring("_key", 1, PREFIX))
    upto = Window.partitionBy(*strata).orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    prefixes = (
        keyed.groupBy(*strata, "_prefix")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_upto", F.sum("_rows").over(upto))
    )
    border_prefix = prefixes.join(targets, strata).filter(
        (F.col("_upto") >= F.col("wanted")) & (F.col("_upto") - F.col("_rows") < F.col("wanted"))
    ).select(*strata, "_prefix", "cut", (F.col("wanted") - F.col("_upto") + F.col("_rows")).alias("_nth"))
    nth = Window.partitionBy(*strata, "cut").orderBy("_key")
    return (
        keyed.join(border_prefix, [*strata, "_prefix"])
        .withColumn("_rank", F.row_number().over(nth))
        .filter(F.col("_rank") == F.col("_nth"))
        .select(*strata, "cut", F.col("_key").alias("border"))
    )


def border(narrow: DataFrame, n: int) -> Column:
    """The ``n``-th smallest ``_key`` of the whole table (the largest if there are fewer), as a value inside a lazy
    plan.  The running count covers at most 65,536 prefixes and gives the number of rows as well."""
    keyed = narrow.select("_key", F.substring("_key", 1, PREFIX).alias("_prefix"))
    everything = Window.partitionBy(F.lit(0))
    upto = everything.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, 0)
    prefixes = (
        keyed.groupBy("_prefix")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_upto", F.sum("_rows").over(upto))
        .withColumn("_wanted", F.least(F.sum("_rows").over(everything), F.lit(n)))
    )
    in_it = (F.col("_upto") >= F.col("_wanted")) & (F.col("_upto") - F.col("_rows") < F.col("_wanted"))
    border_prefix = prefixes.filter(in_it).select("_prefix", (F.col("_wanted") - F.col("_upto") + F.col("_rows")).alias("_nth"))
    nth = Window.partitionBy("_prefix").orderBy("_key")
    return (
        keyed.join(border_prefix, "_prefix")
        .withColumn("_rank", F.row_number().over(nth))
        .filter(F.col("_rank") == F.col("_nth"))
        .select("_key")
        .scalar()
    )


def sample_rows(df: DataFrame, n: int, id_column: str = "review_id", seed: int = settings.SEED) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the ones with the smallest hashes."""
    key = row_key(df, id_column, seed)
    return df.filter(key <= border(df.select(key.alias("_key")), n))


def sample_for_mode(df: DataFrame, mode: str, id_column: str = "review_id") -> DataFrame:
    return sample_rows(df, settings.QUICK_SAMPLE_ROWS, id_column) if mode == "quick" else df


def balanced_sample(
    df: DataFrame,
    per_class: int,
    label: str = "sentiment_label",
    id_column: str = "review_id",
    required: Sequence[str] = ("clean_text",),
    seed: int = settings.SEED,
) -> DataFrame:
    """At most ``per_class`` rows of every label; rows without text or label do not count."""
    usable = df.dropna(subset=[*required, label])
    key = row_key(df, id_column, seed)
    keyed = usable.withColumn("_own", key)
    narrow = keyed.select(label, F.col("_own").alias("_key"))
    sizes = narrow.groupBy(label).agg(F.least(F.count("*"), F.lit(per_class)).alias("wanted"))
    limits = borders(narrow, sizes.withColumn("cut", F.lit("in")), [label]).select(label, "border")
    return keyed.join(limits, label).filter(F.col("_own") <= F.col("border")).select(*df.columns)


def stratify_check(df: DataFrame, column: str) -> DataFrame:
    """One row: number of classes (null is one), smallest class, whether a stratified split works."""
    sizes = df.groupBy(column).agg(F.count("*").alias("rows"))
    return sizes.agg(
        F.count("*").alias("classes"), F.coalesce(F.min("rows"), F.lit(0)).alias("smallest")
    ).withColumn("usable", (F.col("classes") >= 2) & (F.col("smallest") >= 2))


def choose_stratify_column(df: DataFrame, sentiment_available: bool) -> str | None:
    """The sentiment label, else the praise flag if it varies, else none."""
    if sentiment_available:
        return "sentiment_label"
    if "not_praise" in df.columns and df.agg(F.count_distinct("not_praise")).first()[0] > 1:
        return "not_praise"
    return None


def apportion(sizes: DataFrame, share_of: str, total: str, target: str) -> DataFrame:
    """Add ``target``: how many of ``total`` rows each class gives, in proportion to ``share_of``.

    Whole parts first, the rest one by one to the largest remainders (ties: smaller class name).
    ``sizes`` has one row per class.
    """
    everything = Window.partitionBy(F.lit(0))
    exact = F.col(share_of) * F.col(total) / F.sum(share_of).over(everything)
    whole = F.floor(exact)
    ordered = Window.partitionBy(F.lit(0)).orderBy(F.col("_left").desc(), F.col("_class").asc_nulls_first())
    return (
        sizes.withColumn("_whole", whole)
        .withColumn("_left", F.round(exact - whole, 9))
        .withColumn("_missing", F.col(total) - F.sum("_whole").over(everything))
        .withColumn(target, F.col("_whole") + (F.row_number().over(ordered) <= F.col("_missing")).cast("long"))
        .drop("_whole", "_left", "_missing")
    )


def split_plan(
    classes: DataFrame,
    test_share: float = settings.TEST_SHARE,
    val_share: float = settings.VAL_SHARE,
) -> DataFrame:
    """From (``_class``, ``rows``) to rows per class in test, val and train.

    The totals are those of two successive splits: ``ceil(test_share * n)`` first, then
    ``ceil`` of the validation share of what is left.
    """
    everything = Window.partitionBy(F.lit(0))
    rest_share = val_share / (1.0 - test_share)
    total = F.sum("rows").over(everything)
    first = classes.withColumn("_keep", total - F.ceil(F.lit(test_share) * total))
    first = apportion(first, "rows", "_keep", "_rest").withColumn("test", F.col("rows") - F.col("_rest"))
    second = first.withColumn("_keep2", F.col("_keep") - F.ceil(F.lit(rest_share) * F.col("_keep")))
    second = apportion(second, "_rest", "_keep2", "train").withColumn("val", F.col("_rest") - F.col("train"))
    return second.select("_class", "rows", "train", "val", "test")


def split_rows(
    df: DataFrame,
    stratify: str | None = "sentiment_label",
    id_column: str = "review_id",
    test_share: float = settings.TEST_SHARE,
    val_share: float = settings.VAL_SHARE,
    seed: int = settings.SEED,
) -> DataFrame:
    """Add ``split`` (train, val, test).  Falls back to an unstratified split when a class is too small, and to an
    unstratified cut between train and val when the test rows leave a class too small for that.  ``df`` is scanned
    three times, twice for (label, key) only: pass a stored table.  Any number of strata: the borders of
    few are broadcast, those of many are a table that the planner joins as it sees fit."""
    if stratify is not None and not stratify_check(df, stratify).first()["usable"]:
        stratify = None
    # A null label is a class of its own; the prefix keeps it apart from any real value.
    stratum = F.lit("all")
    if stratify is not None:
        stratum = F.coalesce(F.concat(F.lit("="), F.col(stratify).cast("string")), F.lit("none"))
    keyed = df.withColumn("_own", row_key(df, id_column, seed)).withColumn("_class", stratum)
    narrow = keyed.select("_class", F.col("_own").alias("_key"))
    plan = split_plan(narrow.groupBy("_class").agg(F.count("*").alias("rows")), test_share, val_share)
    left = plan.agg(
        F.count("*").alias("classes"), F.min(F.col("rows") - F.col("test")).alias("smallest"), F.sum("val").alias("val")
    ).first()  # one row
    by_class = left["classes"] < 2 or (left["smallest"] or 0) >= 2
    cuts = "stack(2, 'test', test, 'val', test + val)" if by_class else "stack(1, 'test', test)"
    limits = (
        borders(narrow, plan.select("_class", F.expr(f"{cuts} as (cut, wanted)")).filter("wanted > 0"), ["_class"])
        .groupBy("_class")
        .pivot("cut", ["test", "val"])
        .agg(F.first("border"))
        .withColumnsRenamed({"test": "_test", "val": "_val"})
    )
    # Left to itself the planner may have started to shuffle the wide table by class, all rows of one in one task.
    placed = keyed.join(F.broadcast(limits) if left["classes"] <= FEW_STRATA else limits, "_class", "left")
    in_test = F.coalesce(F.col("_own") <= F.col("_test"), F.lit(False))
    in_val = F.col("_own") <= F.col("_val")
    if not by_class and left["val"]:
        in_val = F.col("_own") <= border(placed.filter(~in_test).select(F.col("_own").alias("_key")), left["val"])
    split = F.when(in_test, "test").when(in_val, "val").otherwise("train")
    return placed.withColumn("split", split).select(*df.columns, "split")


def split_sizes(split: DataFrame, label: str) -> DataFrame:
    return split.groupBy(label, "split").agg(F.count("*").alias("rows"))


def course_holdout(
    df: DataFrame,
    course: str = "course_id",
    share: float = settings.HOLDOUT_SHARE,
    min_courses: int = 2,
    seed: int = settings.SEED,
) -> DataFrame | None:
    """Add ``split``: all rows of ``max(1, round(share * courses))`` courses are test, the others and
    rows without a course are train.  None when there are fewer than ``min_courses`` courses.

    The held-out courses are those with the smallest hashes, so membership is a comparison with
    one value; there is no list of courses to broadcast or join.
    """
    courses = df.select(course).filter(F.col(course).isNotNull()).distinct()
    count = courses.count()
    if count < min_courses:
        return None
    wanted = max(1, round(count * share))  # Python rounds half to even, as wanted here
    limit = border(courses.select(hash_key(course, seed).alias("_key")), wanted)
    held_out = F.col(course).isNotNull() & (hash_key(course, seed) <= limit)
    return df.withColumn("split", F.when(held_out, "test").otherwise("train"))
