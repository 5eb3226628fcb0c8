"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

At each level a document draws a number for every child, -ln(u) / weight with u from a hash of its id and the
child's name, and goes to the child with the smallest.  A subtree weighs as much as its shards.  A draw does
not depend on the other children, so a changed weight moves documents only into the subtree that gained, or
out of the one that lost; all other subtrees keep theirs.

``Tree.grown`` adds one shard as a region of its own: no existing weight changes, so the new shard only
takes documents and none moves between the old ones.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.shared import id_text, numbered, unit_draw

# Cells per shard for numbering the slots; fixed, so a task's share shrinks as tasks are added.
CELLS = 1024


@dataclass(frozen=True)
class Tree:
    """``regions[i][j][k]`` is the weight of shard k in rack j of region i; shards are numbered in that order."""

    regions: tuple[tuple[tuple[float, ...], ...], ...]

    @staticmethod
    def even(regions: int, racks: int, shards: int) -> Tree:
        return Tree((((1.0,) * shards,) * racks,) * regions)

    def grown(self, weight: float = 1.0) -> Tree:
        return Tree((*self.regions, ((weight,),)))

    @property
    def shards(self) -> int:
        return sum(len(rack) for region in self.regions for rack in region)


def draw(key: Column, name: str, weight: float) -> Column:
    return -F.log(unit_draw(F.concat(key, F.lit(f"/{name}")))) / F.lit(weight)


def choose(key: Column, children: list[tuple[str, float, Column]]) -> Column:
    """The value of the child with the smallest draw; the first of equals.  Children without weight get nothing."""
    children = [child for child in children if child[1] > 0]
    if len(children) == 1:
        return children[0][2]
    draws = [F.struct(draw(key, name, weight).alias("draw"), F.lit(i).alias("i")) for i, (name, weight, _) in enumerate(children)]
    winner = F.least(*draws)["i"]
    return reduce(lambda rest, i: F.when(winner == i, children[i][2]).otherwise(rest), range(len(children) - 1), children[-1][2])


def shard_of(key: Column, tree: Tree) -> Column:
    """Descends the tree: the shard's number."""
    number = 0
    regions = []
    for i, region in enumerate(tree.regions):
        racks = []
        for j, rack in enumerate(region):
            shards = [(f"{i}/{j}/{k}", weight, F.lit(number + k)) for k, weight in enumerate(rack)]
            number += len(rack)
            if sum(rack) > 0:
                racks.append((f"{i}/{j}", sum(rack), choose(key, shards)))
        if racks:
            regions.append((f"{i}", sum(weight for _, weight, _ in racks), choose(key, racks)))
    if not regions:
        raise ValueError("the tree has no shard with a weight")
    return choose(key, regions)


def place(docs: DataFrame, tree: Tree, carried: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard, and the ``carried`` columns.

    Law ``key``: the id and the tree decide.  Size is the text's UTF-8 bytes plus 1 (null text: 1, crc 0).
    Rows with the same id share a shard; null ids count as the id "null".  Slots are 0, 1, 2, ... within a shard, by a
    hash of id and text.  Columns that are not carried are ignored; a carried one may not have a result's name.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        *carried,
    )
    key = id_text(F.col("doc_id"))
    placed = rows.select(
        "*",
        F.lit("key").alias("law"),
        shard_of(key, tree).cast("int").alias("shard"),
        shard_of(key, tree.grown()).cast("int").alias("grown_shard"),
        F.pmod(F.xxhash64(key, "text_crc32"), F.lit(CELLS)).cast("int").alias("_cell"),
    )
    return numbered(placed, "shard", "_cell", ["doc_id", "text_crc32", "size"], "slot").select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard", *carried
    )
