"""Exact duplicates by block naming.

A normalised text is cut into blocks of ``BLOCK`` bytes.  Equal blocks get the same integer name and different blocks
different ones; then the names of adjacent blocks are paired and each distinct pair gets a name, and so on, until a
text has one name.  Two texts are equal if and only if they took the same number of rounds and end with the same name:
no step trusts a hash.

1. Block keys: 128 hashed bits per block.  One pass over the distinct (key, content) rows proves that no two contents
   share a key; if two did, the next seed is taken.  So a key stands for its content, and contents cross the network
   once, each distinct one once per task.
2. Names: the distinct keys, sorted over the cluster, numbered in that order.  A pair of names is named likewise.
3. Keys that hold over one ``HOT``-th of all rows, ``HOT`` at most, are looked up in a broadcast; the others in a join
   whose largest key is bounded by that share.  So a text that a third of all rows copy does not meet in one task.

A text of n blocks takes log2(n) rounds, each with half the rows of the one before; most texts are one block long.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.session import materialise

BLOCK = 16_384
HOT = 4096
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(text: Column) -> Column:
    """A-Z in lower case, nothing else changed; null as empty.  ``lower`` is fast and right for texts in ASCII."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def blocks(text: Column, size: int = BLOCK) -> Column:
    """The bytes of a text in pieces of ``size``; one empty piece for an empty text.  The outer array holds the bytes,
    so that they are computed once and not for every piece."""
    whole = F.array(text.cast("binary"))
    starts = lambda raw: F.sequence(F.lit(0), F.greatest(F.octet_length(raw) - 1, F.lit(0)), F.lit(size))
    return F.flatten(F.transform(whole, lambda raw: F.transform(starts(raw), lambda at: F.substring(raw, at + 1, F.lit(size)))))


def block_key(block: Column, seed: int) -> Column:
    """128 bits of a block as two numbers."""
    return F.struct(F.xxhash64(block, F.lit(2 * seed)).alias("x"), F.xxhash64(F.lit(2 * seed + 1), block).alias("y"))


def proven_seed(texts: DataFrame, key: Callable[[Column, int], Column], size: int = BLOCK) -> int:
    """The first seed under which no two different blocks of ``texts`` (column ``norm``) have the same key."""
    seed = 0
    while True:
        contents = texts.select(F.explode(blocks(F.col("norm"), size)).alias("block")).select(key(F.col("block"), seed).alias("key"), "block")
        distinct = contents.groupBy("key", "block").agg(F.lit(1).alias("one")).select("key.x", "key.y")
        if distinct.groupBy("x", "y").count().filter("count > 1").isEmpty():
            return seed
        seed += 1


def names_of(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, uses, name: the distinct keys in sorted order, with an integer each that rises in that order.  The keys
    are never null: an absent one is -1."""
    distinct = rows.groupBy(*keys).agg(F.count("*").alias("uses"))
    return materialise(distinct.orderBy(*keys).withColumn("name", F.monotonically_increasing_id()))


def looked_up(rows: DataFrame, table: DataFrame, keys: Sequence[str], hot: int = HOT) -> DataFrame:
    """``rows`` with the other columns of ``table``, one row per key, whose ``uses`` say how many rows have the key.
    At most ``hot`` keys can have more than one ``hot``-th of the rows each: the broadcast is bounded."""
    total = table.agg(F.coalesce(F.sum("uses"), F.lit(0)).alias("total")).first()["total"]
    often = F.col("uses") * hot > total
    carried = [c for c in table.columns if c not in (*keys, "uses")]
    frequent = table.filter(often).select(*keys, F.struct(*carried).alias("_frequent"))
    rare = table.filter(~often).select(*keys, *carried)
    met = rows.join(F.broadcast(frequent), list(keys), "left")
    first = met.filter("_frequent is not null").select(*rows.columns, *[F.col(f"_frequent.{c}").alias(c) for c in carried])
    rest = met.filter("_frequent is null").select(*rows.columns).join(rare, list(keys))
    return first.unionByName(rest.select(*rows.columns, *carried))


def identities(rows: DataFrame) -> DataFrame:
    """row, rounds, name: one identity per text, from (row, place, x, y), the keys of its blocks in order."""
    named = looked_up(rows, names_of(rows, ["x", "y"]), ["x", "y"]).select("row", "place", "name")
    sizes = rows.groupBy("row").agg(F.count("*").alias("size"))
    done, rounds = [], 0
    # ``size``: names that the text still has; it is carried along, halved in each round.
    named = materialise(named.join(sizes.filter("size > 1"), "row", "left").withColumn("size", F.coalesce("size", F.lit(1))))
    while True:
        done.append(named.filter("size = 1").select("row", F.lit(rounds).alias("rounds"), "name"))
        longer = named.filter("size > 1")
        if longer.isEmpty():
            break
        left = F.col("place") % 2 == 0
        pairs = materialise(
            longer.groupBy("row", F.floor(F.col("place") / 2).alias("place")).agg(
                F.max(F.when(left, F.col("name"))).alias("x"),
                F.coalesce(F.max(F.when(~left, F.col("name"))), F.lit(-1)).alias("y"),
                F.first("size").alias("size"),
            )
        )
        found = looked_up(pairs, names_of(pairs, ["x", "y"]), ["x", "y"])
        named = materialise(found.select("row", "place", "name", F.ceil(F.col("size") / 2).alias("size")))
        rounds += 1
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole


def exact_duplicates(docs: DataFrame, key: Callable[[Column, int], Column] = block_key, size: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    ``docs`` needs doc_id and text; other columns are ignored.  Texts are equal if they are after lower-casing A-Z;
    null counts as empty, and empty texts are one group.  Of a group the row with the largest doc_id is kept; rows
    without an id come last, and of rows that repeat the largest id one is kept, so a group always keeps exactly one
    row.  A text may be of any length.  An empty table gives an empty result.  ``size`` is the block's
    length in bytes and changes nothing in the result; ``key`` is for tests.
    """
    texts = docs.select("doc_id", normalised(F.col("text")).alias("norm"))
    seed = proven_seed(texts, key, size)
    keys = F.transform(blocks(F.col("norm"), size), lambda block: key(block, seed))
    rows = materialise(
        texts.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("doc_id").cast("long").alias("doc_id"),
            F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
            keys.alias("keys"),
        )
    )
    found = identities(rows.select("row", F.posexplode("keys").alias("place", "key")).select("row", "place", "key.x", "key.y"))
    members = materialise(rows.drop("keys").join(found, "row"))
    # Ids ascending with null first: the largest struct is the row that stays.
    best = F.max(F.struct("doc_id", "row"))
    groups = materialise(members.groupBy("rounds", "name").agg(F.count("*").alias("uses"), best.alias("best")))
    groups = groups.select("rounds", "name", "uses", F.col("uses").alias("group_size"), F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("keep_row"))
    return looked_up(members, groups, ["rounds", "name"]).select(
        "doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "text_sha256"
    )
