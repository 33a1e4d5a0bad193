"""Sharding by a hierarchical weighted hash tree.

A tree of regions, racks and shards; a node weighs what its shards weigh.  A row
descends from the root: at each level every child draws ``-ln(u) / weight``, with
``u`` from a hash of the row's key and the child's own name, and the smallest draw
wins.  A draw depends on nothing but key, name and weight.  So a heavier child only
wins rows, a lighter one only loses some, and all other children keep theirs: rows
move only into or out of subtrees whose weight changed.  A shard added as a region
of its own takes rows only into itself.

Cases: a null key is a key like any other (all such rows share a shard); equal keys
share a shard; null text counts as empty; an empty table gives no rows.  Extra
columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cargolens.llm.common import Scratch, dense_slots, read


@dataclass(frozen=True)
class Tree:
    """``regions[i][j]`` holds the (shard, weight) pairs of a rack.

    A node is named by its first shard at the time it was made, so adding nodes
    renames none.  The draws become one column expression, meant for up to some
    thousand nodes.
    """

    regions: tuple[tuple[tuple[tuple[int, float], ...], ...], ...]

    @classmethod
    def balanced(cls, regions: int, racks: int, shards: int) -> Tree:
        numbers = iter(range(regions * racks * shards))
        return cls(
            tuple(
                tuple(tuple((next(numbers), 1.0) for _ in range(shards)) for _ in range(racks))
                for _ in range(regions)
            )
        )

    def with_region(self, weight: float = 1.0) -> Tree:
        """One more shard, in a new region: rows move only into it."""
        shard = 1 + max((s for r in self.regions for k in r for s, _ in k), default=-1)
        return Tree((*self.regions, (((shard, weight),),)))

    def with_weight(self, shard: int, weight: float) -> Tree:
        """Another weight for one shard."""
        return Tree(
            tuple(
                tuple(tuple((s, weight if s == shard else w) for s, w in rack) for rack in region)
                for region in self.regions
            )
        )


def _weight(node) -> float:
    return node[1] if isinstance(node[0], int) else sum(_weight(x) for x in node)


def _name(node) -> int:
    return node[0] if isinstance(node[0], int) else _name(node[0])


def _draw(key: Column, level: str, node) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(level), F.lit(_name(node))), 11)
    u = (bits.cast("double") + F.lit(0.5)) / F.lit(float(2**53))
    return -F.log(u) / F.lit(_weight(node))


def shard_of(key: Column, tree: Tree) -> Column:
    """The shard of a key."""

    def descend(children, levels) -> Column:
        alive = [x for x in children if _weight(x) > 0]
        if len(alive) == 1:
            below = [F.lit(True)]
        else:
            draws = [_draw(key, levels[0], x) for x in alive]
            pairs = [F.struct(d.alias("d"), F.lit(i).alias("i")) for i, d in enumerate(draws)]
            best = F.least(*pairs)["i"]
            below = [best == i for i in range(len(alive))]
        out = None
        for won, node in zip(below, alive):
            inner = F.lit(node[0]) if isinstance(node[0], int) else descend(node, levels[1:])
            out = F.when(won, inner) if out is None else out.when(won, inner)
        return out

    return descend(tree.regions, ("region", "rack", "shard")).cast("int")


def assign(docs: DataFrame, tree: Tree, grown: Tree | None = None, key: str = "doc_id") -> DataFrame:
    """key, size (UTF-8 bytes of ``text`` plus 1), text_crc32, shard, slot, grown_shard.

    ``slot`` is gapless from 0 in each shard, in key order.  Only these small columns
    are sorted, never the text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    # Rows that agree in all else still differ in the scan's row number, so equal
    # rows spread over the sort's tasks however many they are.
    rows = docs.select(
        F.col(key),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        shard_of(F.col(key), tree).alias("shard"),
        (shard_of(F.col(key), grown) if grown else F.lit(None).cast("int")).alias("grown_shard"),
        F.monotonically_increasing_id().alias("row_in_scan"),
    )
    order = [key, "text_crc32", "size", "row_in_scan"]
    return dense_slots(rows, "shard", order, Scratch(docs.sparkSession), "slot")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 8 shards of two regions with two racks each, and with a ninth."""
    tree = Tree.balanced(2, 2, 2)
    placed = assign(read(spark, sf_dir, "documents"), tree, tree.with_region())
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )
