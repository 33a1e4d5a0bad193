"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cargolens.llm.common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    larger = both.where("v > u").join(least, "u")
    return larger.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    others = down.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return own.unionByName(others).distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(u, v) for every node that is not the smallest of its component: v is that one.

    ``edges`` has number columns u and v; loops and repeated edges do no harm.  Every
    round keeps at most as many edges as there were, and is written to the shared
    folder.  Minima are pre-aggregated, so a node with very many links is no hot group
    there; in the joins the other side has one row per node.
    """
    current = scratch.table(edges.where("u != v").select("u", "v").distinct(), "edges")
    seen = None
    while True:
        after = scratch.table(_small_star(_large_star(current)), "edges")
        state = after.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        scratch.drop(current)
        if tuple(state) == seen:
            return after
        current, seen = after, tuple(state)
