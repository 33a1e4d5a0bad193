"""Whitening of embeddings from exact variances by polarisation.

Vectors are counted in whole steps (x = floor(scale * c) + offset), so every sum below is
a whole number and exact in any order.

1. The fit list is each distinct vector once: copies add nothing, however many there are.
2. One pass gives the number of vectors n and the sum of each dimension.  Values are
   then centred at the whole number nearest the mean, so they stay small; what is left of
   the mean is taken off exactly in step 4.
3. One pass adds up the squared centred values of every dimension i, and of the sum of
   every pair of dimensions (i, j).  Tasks add in 64 bits where that is proven to be
   enough, and in Python's integers elsewhere; Spark adds what the tasks found.
4. n^2 var(t) = n sum(t^2) - sum(t)^2 for every dimension and pair sum t, and
   2 cov(i, j) = var(i + j) - var(i) - var(j), all in whole numbers.  The matrix has
   dimensions^2 entries whatever the table's size; eigh gives its components.
5. A last pass projects each row of the table.

Cases: rows whose vector is null, empty, or holds a null or non-finite value take no part.
Neither do vectors of another length than most have (of equally frequent lengths the longest
counts).  Repeated rows are returned each.  Components without variance (below what double
precision tells from zero) are left out, so vectors that are all alike, or an empty table,
give no rows.  A deviation that a long cannot hold is null.  A null vec_id stays null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cargolens.llm.common import Scratch, read

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
_LONG = (1 << 63) - 1
_LIMB = 10**18  # sums travel as two decimals, so no sum is too long for one


@dataclass(frozen=True)
class Whitening:
    """Means, components and eigenvalues of a fit list; what a task needs to project."""

    n: int
    center: tuple[int, ...]  # whole numbers near the means
    rest: tuple[int, ...]  # sum of each dimension less n times its center
    widest: int  # largest distance of a value from its center
    axes: np.ndarray  # a column of length 1 for each component
    eigenvalues: np.ndarray
    trace: float
    identity_error: float

    @property
    def explained(self) -> np.ndarray:
        return self.eigenvalues / self.trace


def _usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(fine, F.lit(False))


def whole(vectors: DataFrame, column: str = "embedding", scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """vec_id and ``x``, the vector in whole steps, of every row that takes part."""
    doubles = F.col(column).cast("array<double>")
    usable = vectors.where(_usable(doubles)).select(
        "vec_id", F.transform(doubles, lambda c: F.floor(c * scale) + F.lit(offset)).alias("x")
    )
    sizes = usable.groupBy(F.size("x").alias("size")).count()
    size = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return usable.where(F.size("x") == (size["size"] if size else 0))


def _matrix(batch: pa.RecordBatch, center: tuple[int, ...], wide: bool) -> np.ndarray:
    """Rows less their centers; Python's integers if ``wide``."""
    flat = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(center))
    if wide:
        return flat.astype(object) - np.array(center, object)
    return flat - np.array(center, np.int64)


def _squares(center: tuple[int, ...], widest: int):
    """A function that adds up the squares of dimensions and pair sums over a task's rows."""
    dims = len(center)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((dims, dims), object)  # [i, i]: a dimension, [i, j]: a pair sum
        for batch in batches:
            # A pair sum is at most twice the widest value.
            wide = 4 * widest * widest * max(batch.num_rows, 1) > _LONG
            z = _matrix(batch, center, wide)
            for i in range(dims):
                sums = z[:, i:] + z[:, i : i + 1]
                sums[:, 0] = z[:, i]
                totals[i, i:] += (sums * sums).sum(axis=0).astype(object)
        i, j = np.triu_indices(dims)
        parts = [divmod(int(t), _LIMB) for t in totals[i, j]]
        exact = pa.decimal128(38, 0)
        yield pa.record_batch(
            {
                "i": pa.array(i, pa.int32()),
                "j": pa.array(j, pa.int32()),
                "high": pa.array([Decimal(h) for h, _ in parts], exact),
                "low": pa.array([Decimal(low) for _, low in parts], exact),
            }
        )

    return run


def covariance(n: int, sums: tuple[int, ...], squares: dict[tuple[int, int], int]) -> list[list[int]]:
    """n^2 times the covariance, in whole numbers, from variances alone.

    ``sums`` holds the sum of each dimension; ``squares`` the sum of squares of each dimension
    under (i, i) and of each pair sum under (i, j).
    """
    dims = range(len(sums))
    variance = [n * squares[i, i] - sums[i] ** 2 for i in dims]
    out = [[0] * len(sums) for _ in dims]
    for i in dims:
        out[i][i] = variance[i]
        for j in range(i + 1, len(sums)):
            both = n * squares[i, j] - (sums[i] + sums[j]) ** 2
            out[i][j] = out[j][i] = (both - variance[i] - variance[j]) // 2  # always even
    return out


def fit(x: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the distinct vectors ``x`` (arrays of longs of one length)."""
    scratch = Scratch(x.sparkSession)
    listed = scratch.table(x.select("x").distinct(), "fit")
    value = F.col("value").cast("decimal(20,0)")
    per_dimension = (
        listed.select(F.posexplode("x").alias("at", "value"))
        .groupBy("at")
        .agg(F.count("*").alias("n"), F.sum(value).alias("sum"), F.min("value").alias("least"), F.max("value").alias("most"))
        .orderBy("at")
        .collect()  # a row per dimension
    )
    if not per_dimension:
        scratch.drop(listed)
        return None
    n = per_dimension[0]["n"]
    totals = [int(r["sum"]) for r in per_dimension]
    center = tuple((2 * s + n) // (2 * n) for s in totals)
    rest = tuple(s - n * c for s, c in zip(totals, center))
    widest = max(max(abs(r["least"] - c), abs(r["most"] - c)) for r, c in zip(per_dimension, center))

    found = listed.mapInArrow(_squares(center, widest), "i int, j int, high decimal(38,0), low decimal(38,0)")
    added = found.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect()
    scratch.drop(listed)
    squares = {(r["i"], r["j"]): int(r["high"]) * _LIMB + int(r["low"]) for r in added}
    exact = covariance(n, rest, squares)
    matrix = np.array([[c / (n * n) for c in row] for row in exact])  # each rounded once
    trace = sum(exact[i][i] for i in range(len(exact))) / (n * n)
    values, axes = np.linalg.eigh(matrix)
    order = np.argsort(-values, kind="stable")[:components]
    order = order[values[order] > max(values[-1], 0.0) * len(center) * np.finfo(float).eps]
    values, axes = values[order], np.ascontiguousarray(axes[:, order])
    # The covariance of what is whitened, from the exact matrix.
    scaled = axes / np.sqrt(values)
    error = np.abs(scaled.T @ matrix @ scaled - np.eye(len(order))).max() if len(order) else 0.0
    return Whitening(n, center, rest, widest, axes, values, trace, float(error))


def _deviations(z: np.ndarray, model: Whitening) -> pa.Array:
    """Sum over the dimensions of (n * x - sum)^2."""
    bound = (model.n * model.widest + max(map(abs, model.rest))) ** 2 * len(model.center)
    if bound <= _LONG:
        apart = z.astype(np.int64) * model.n - np.array(model.rest, np.int64)
        return pa.array((apart * apart).sum(axis=1), pa.int64())
    apart = z.astype(object) * model.n - np.array(model.rest, object)
    return pa.array([d if d <= _LONG else None for d in (apart * apart).sum(axis=1)], pa.int64())


def whiten(x: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, deviation and the array ``whitened`` (a number for each component) of every row."""
    mean = np.array([r / model.n for r in model.rest])
    scaled = model.axes / np.sqrt(model.eigenvalues)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = _matrix(batch, model.center, model.widest > _LONG // 2)
            projected = np.ascontiguousarray((z.astype(float) - mean) @ scaled)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * projected.shape[1]
            yield pa.record_batch(
                {
                    "vec_id": batch["vec_id"],
                    "deviation": _deviations(z, model),
                    "whitened": pa.ListArray.from_arrays(pa.array(ends), pa.array(projected.ravel())),
                }
            )

    kind = x.schema["vec_id"].dataType.simpleString()
    return x.select("vec_id", "x").mapInArrow(run, f"vec_id {kind}, deviation long, whitened array<double>")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 16 strongest whitened components of every embedding."""
    x = whole(read(spark, sf_dir, "embeddings"))
    model = fit(x)
    kind = x.schema["vec_id"].dataType.simpleString()
    if model is None or not len(model.eigenvalues):
        schema = (
            f"vec_id {kind}, component int, n long, deviation long, whitened double, "
            "explained double, identity_error double"
        )
        return spark.createDataFrame([], schema)
    explained = F.array(*[F.lit(float(e)) for e in model.explained])
    return whiten(x, model).select(
        "vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")
    ).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
