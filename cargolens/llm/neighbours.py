"""Approximate nearest neighbours by inner product: NN-descent and greedy graph search.

Rows with one vector are one node: it carries the smallest ``nearest`` + 1 of their
ids, and more can never be among the nearest.  The neighbour graph starts from blocks of
nodes on the same side of a few random hyperplanes.  Then, in rounds, every node brings
its neighbours and those that have it as neighbour together, and each pair of them in
which one is new is scored: neighbours of neighbours, found by Spark joins and scored by
a matrix product per node.  Scores go to a node only if they beat the worst neighbour it
has.  A node with very many reverse neighbours is dealt out in pieces, differently in each
round; no neighbour is dropped.  Rounds end when few neighbours change.

A query is a row and so a node of the graph.  Its search starts at its own neighbours and
in each round walks on from the best nodes not yet visited, along edges in both
directions.  Vectors travel unrounded, as 32-bit floats where all their values are such and
as 64-bit floats otherwise, and every score is a double: graph and search rank as the exact
scores do, up to the order of a sum.  The best nodes found are scored anew on the original
vectors, with ties to the smaller id.

Cases: a vector that is null, zero, or holds a null, a NaN or an infinity takes no part,
nor does a row with a null id; where lengths differ the most frequent length takes part
(the larger one of equally frequent ones); repeated rows count once; with fewer
candidates than wanted all are returned; equal vectors in any number are one node; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from cargolens.llm.common import Scratch, read

DEGREE = 48  # neighbours of a node
PIECE = 128  # nodes that are compared with each other for one node at a time
BLOCK = 400  # nodes of a first block
STARTS = 3  # first blockings
ROUNDS = 6
CHANGED = 0.02  # part of new neighbours at which the graph is done
WIDTH = 64  # best nodes of a search that are walked on from
STEPS = 3


def _usable(rows: DataFrame) -> DataFrame:
    """vec_id and vector (doubles) of the rows that take part, each once."""
    vector = F.col("embedding").cast("array<double>")
    rows = rows.select("vec_id", vector.alias("vector")).where(
        F.col("vec_id").isNotNull()
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != math.inf))
        & F.exists("vector", lambda x: x != 0)
    )
    length = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return rows.where(F.size("vector") == (length["n"] if length else 0))


@F.pandas_udf(T.BinaryType())
def _code(vectors: pd.Series) -> pd.Series:
    """All values without loss: the width of a float (4 or 8), then the floats."""

    def code(v) -> bytes:
        wide = np.asarray(v, np.float64)
        with np.errstate(over="ignore", under="ignore"):
            short = wide.astype(np.float32)
        return b"\4" + short.tobytes() if (short == wide).all() else b"\x08" + wide.tobytes()

    return vectors.map(code)


def _nodes(rows: DataFrame, nearest: int) -> DataFrame:
    """node (smallest id), vector, code, ids (the smallest ones) of each distinct vector."""
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    # The window's limit is applied before the shuffle too, so copies in any number are few.
    few = rows.distinct().withColumn("place", place).where(F.col("place") <= nearest + 1)
    grouped = few.groupBy("vector").agg(
        F.min("vec_id").alias("node"), F.sort_array(F.collect_list("vec_id")).alias("ids")
    )
    return grouped.select("node", "vector", _code("vector").alias("code"), "ids")


def _matrix(codes) -> np.ndarray:
    kinds = {4: np.float32, 8: np.float64}
    codes = list(codes)
    if len({c[0] for c in codes}) > 1:
        return np.stack([np.frombuffer(c, kinds[c[0]], offset=1).astype(np.float64) for c in codes])
    raw = np.frombuffer(b"".join(codes), np.uint8).reshape(len(codes), -1)[:, 1:]
    return np.ascontiguousarray(raw).view(kinds[codes[0][0]]).astype(np.float64)


def _block_neighbours(block: pd.DataFrame) -> pd.DataFrame:
    vectors, node = _matrix(block["code"]), block["node"].to_numpy()
    scores = vectors @ vectors.T
    np.fill_diagonal(scores, -np.inf)
    k = min(DEGREE, len(node) - 1)
    if not k:
        return pd.DataFrame({"u": [], "v": [], "s": []}).astype({"u": "int64", "v": "int64", "s": "float64"})
    at = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    return pd.DataFrame(
        {"u": np.repeat(node, k), "v": node[at].ravel(),
         "s": np.take_along_axis(scores, at, 1).ravel()}
    )


def _side(start: int, bits: int):
    """Function for the side of random hyperplanes that a vector is on, as a number."""

    @F.pandas_udf(T.LongType())
    def side(codes: pd.Series) -> pd.Series:
        vectors = _matrix(codes)
        planes = np.random.RandomState(1 + start).standard_normal((vectors.shape[1], bits))
        return pd.Series((vectors @ planes > 0) @ (1 << np.arange(bits, dtype=np.int64)))

    return side


def _first_edges(nodes: DataFrame, count: int, scratch: Scratch) -> DataFrame:
    """(u, v, s): the best neighbours inside blocks of nodes, for several blockings."""
    bits = max(0, math.ceil(math.log2(max(count, 1) / BLOCK * 2)))
    edges = []
    for start in range(STARTS):
        sided = nodes.select("node", "code", _side(start, bits)("code").alias("side"))
        sizes = sided.groupBy("side").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("pieces"))
        # A side with very many nodes is dealt out at random; blocks stay near BLOCK.
        dealt = sided.join(F.broadcast(sizes), "side").withColumn(
            "piece", F.pmod(F.xxhash64("node", F.lit(start)), F.col("pieces"))
        )
        edges.append(dealt.groupBy("side", "piece").applyInPandas(_block_neighbours, "u long, v long, s double"))
    out = edges[0]
    for more in edges[1:]:
        out = out.unionByName(more)
    return _keep_best(out.withColumn("new", F.lit(True)))


def _keep_best(edges: DataFrame) -> DataFrame:
    """The best neighbours of each node; an edge found again is not new."""
    once = edges.groupBy("u", "v").agg(F.max("s").alias("s"), F.min("new").alias("new"))
    place = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("s"), "v"))
    return once.withColumn("place", place).where(F.col("place") <= DEGREE).drop("place")


def _local_joins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Better neighbours from the rows (u, piece, v, new, worst, code), sorted by (u, piece)."""

    def scored(table: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        v = table["v"].to_numpy()
        new, worst = table["new"].to_numpy(), table["worst"].to_numpy()
        vectors = _matrix(table["code"].to_pylist())
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        for a, b in zip(starts[:-1], starts[1:]):
            if b - a < 2 or not new[a:b].any():
                continue
            scores = vectors[a:b] @ vectors[a:b].T
            good = (scores > worst[a:b, None]) & (new[a:b, None] | new[None, a:b])
            good &= v[a:b, None] != v[None, a:b]
            i, j = np.nonzero(good)
            found.append((v[a + i], v[a + j], scores[i, j]))
        u, v, s = map(np.concatenate, zip(*found))
        once = pd.DataFrame({"u": u, "v": v, "s": s}).drop_duplicates(["u", "v"])
        return pa.RecordBatch.from_pandas(once, preserve_index=False)

    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        u, piece = table["u"].to_numpy(), table["piece"].to_numpy()
        starts = np.r_[0, np.flatnonzero((u[1:] != u[:-1]) | (piece[1:] != piece[:-1])) + 1]
        # The last node's rows may go on in the next batch.
        rest = table.slice(starts[-1])
        if len(starts) > 1:
            yield scored(table, starts)
    if rest is not None:
        yield scored(rest, np.array([0, rest.num_rows]))


def graph(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(u, v, s): the neighbour graph of ``nodes`` (node, code)."""
    count = nodes.count()
    edges = scratch.table(_first_edges(nodes, count, scratch), "graph")
    for turn in range(ROUNDS):
        worst = edges.groupBy("u").agg(
            F.when(F.count("*") >= DEGREE, F.min("s")).otherwise(F.lit(-math.inf)).cast("double").alias("worst")
        )
        known = nodes.select(F.col("node").alias("v"), "code").join(
            worst.withColumnRenamed("u", "v"), "v"
        )
        both = edges.select("u", "v", "new").unionByName(
            edges.select(F.col("v").alias("u"), F.col("u").alias("v"), "new")
        ).groupBy("u", "v").agg(F.max("new").alias("new"))
        sizes = both.groupBy("u").agg(
            F.ceil(F.count("*") / PIECE).cast("int").alias("pieces"), F.max("new").alias("any")
        ).where("any")
        dealt = both.join(sizes, "u").select(
            "u", "v", "new",
            F.pmod(F.xxhash64("v", F.lit(turn)), F.col("pieces")).cast("int").alias("piece"),
        )
        around = dealt.join(known, "v").repartition("u", "piece").sortWithinPartitions("u", "piece")
        better = around.select("u", "piece", "v", "new", "worst", "code").mapInArrow(
            _local_joins, "u long, v long, s double"
        )
        merged = edges.withColumn("new", F.lit(False)).unionByName(better.withColumn("new", F.lit(True)))
        after = scratch.table(_keep_best(merged), "graph")
        scratch.drop(edges)
        edges = after
        changed = edges.where("new").count()
        if changed <= CHANGED * DEGREE * count:
            break
    return edges


@F.pandas_udf(T.DoubleType())
def _score(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series((_matrix(left) * _matrix(right)).sum(1))


def _best(found: DataFrame, width: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("s"), "v"))
    return found.withColumn("place", place).where(F.col("place") <= width).drop("place")


def search(queries: DataFrame, nodes: DataFrame, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(q, v): nodes near each query node ``q`` of ``queries``, itself included."""
    paths = edges.select("u", "v").unionByName(
        edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
    ).distinct()
    paths = scratch.table(paths, "paths")
    codes = nodes.select("node", "code")

    def walk(frontier: DataFrame) -> DataFrame:
        reached = frontier.join(paths, frontier["at"] == paths["u"]).select("q", "v")
        return reached.where("q != v").distinct()

    def scored(pairs: DataFrame) -> DataFrame:
        return (
            pairs.join(codes.toDF("q", "code_q"), "q").join(codes.toDF("v", "code_v"), "v")
            .select("q", "v", _score("code_q", "code_v").alias("s"), F.lit(False).alias("done"))
        )

    first = walk(queries.select("q", F.col("q").alias("at")))
    found = scratch.table(_best(scored(first), 2 * WIDTH), "found")
    for _ in range(STEPS):
        ends = _best(found, WIDTH).where("NOT done").select("q", F.col("v").alias("at"))
        more = walk(ends).join(found.select("q", "v"), ["q", "v"], "left_anti")
        walked = found.join(ends.toDF("q", "v").withColumn("walked", F.lit(True)), ["q", "v"], "left")
        walked = walked.select("q", "v", "s", (F.col("done") | F.coalesce("walked", F.lit(False))).alias("done"))
        after = scratch.table(_best(walked.unionByName(scored(more)), 2 * WIDTH), "found")
        scratch.drop(found)
        found = after
    return found.select("q", "v").unionByName(queries.select("q", F.col("q").alias("v")))


def inner_product(left: Column, right: Column) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)


def nearest_neighbours(rows: DataFrame, is_query: Column, nearest: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score of the rows of ``rows`` nearest to those that are queries."""
    scratch = Scratch(rows.sparkSession)
    usable = _usable(rows)
    nodes = scratch.table(_nodes(usable, nearest), "nodes")
    edges = graph(nodes.select("node", "code"), scratch)

    asked = usable.where(is_query).distinct().join(nodes.select("vector", "node"), "vector")
    asked = scratch.table(asked.select(F.col("vec_id").alias("query_id"), F.col("node").alias("q")), "asked")
    found = search(asked.select("q").distinct(), nodes, edges, scratch)

    # Exact scores of the nodes found; then their ids, without the query's own.
    pair = (
        found.join(nodes.select(F.col("node").alias("q"), F.col("vector").alias("vector_q")), "q")
        .join(nodes.select(F.col("node").alias("v"), "vector", "ids"), "v")
        .select("q", "ids", inner_product(F.col("vector_q"), F.col("vector")).alias("score"))
    )
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "ids"))
    pair = pair.withColumn("place", place).where(F.col("place") <= nearest + 1).drop("place")
    listed = asked.join(pair, "q").select(
        "q", "query_id", F.explode("ids").alias("vec_id"), "score"
    ).where("vec_id != query_id")
    rank = F.row_number().over(Window.partitionBy("query_id", "q").orderBy(F.desc("score"), "vec_id"))
    return (
        listed.withColumn("rank", rank).where(F.col("rank") <= nearest)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 rows nearest to every row whose vec_id is divisible by 20."""
    return nearest_neighbours(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
