import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest

from cargolens.llm import whitening
from cargolens.llm.whitening import covariance, fit, op11_whitening, whiten, whole

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(seed=1, n=120, dims=20, scale=1.0):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(dims, dims)) * np.linspace(3, 0.4, dims)
    return [(k, [float(np.float32(c)) for c in row], 0) for k, row in enumerate((rng.normal(size=(n, dims)) @ mix + 5) * scale)]


def odd(dims=20):
    nan, inf = float("nan"), float("inf")
    fine = vectors(3, 5, dims)
    broken = [None, [], [nan] * dims, [1.0] * (dims - 1) + [inf], [None] + [1.0] * (dims - 1), [1.0, 2.0], [-inf] * dims]
    return [(900 + k, v, None) for k, v in enumerate(broken)] + [(None, fine[0][1], 1), fine[1], fine[1]]


def brute(rows, dims):
    """Remaining rows, fit list and covariance, in fractions."""
    fine = [(k, v) for k, v, _ in rows if v and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    x = [(k, [math.floor(64 * c) + 1_000_000 for c in v]) for k, v in fine]
    listed = sorted({tuple(v) for _, v in x})
    n, sums = len(listed), [sum(v[d] for v in listed) for d in range(dims)]
    mean = [Fraction(s, n) for s in sums]
    apart = [[v[d] - mean[d] for d in range(dims)] for v in listed]
    cov = [[sum(a[i] * a[j] for a in apart) / n for j in range(dims)] for i in range(dims)]
    return x, n, sums, cov


def folder(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS x", "1 AS n", "2 AS at").write.parquet(f"{path}/embeddings.parquet")
    return str(path)


@pytest.mark.parametrize("scale", [1.0, 1000.0])
def test_same_as_fractions(spark, tmp_path, scale):
    dims = 20
    rows = vectors(scale=scale) + [(500 + k, vectors(scale=scale)[7][1], 1) for k in range(60)] + odd()
    x, n, sums, cov = brute(rows, dims)
    found = op11_whitening(spark, folder(spark, tmp_path / "in", rows)).collect()
    assert len(found) == 16 * len(x)
    value = np.array([[float(c) for c in row] for row in cov])
    eigen, axes = np.linalg.eigh(value)
    eigen, axes = eigen[::-1], axes[:, ::-1]
    deviations = Counter((k, sum((n * c - s) ** 2 for c, s in zip(v, sums))) for k, v in x)
    assert Counter((r["vec_id"], r["deviation"]) for r in found if r["component"] == 1) == deviations
    assert {r["n"] for r in found} == {n} and {r["component"] for r in found} == set(range(1, 17))
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-10
    per_row = defaultdict(dict)
    for r in found:
        if r["vec_id"] is not None and r["vec_id"] < 500:
            per_row[r["vec_id"]][r["component"]] = r["whitened"]
        assert r["explained"] == pytest.approx(eigen[r["component"] - 1] / eigen.sum(), rel=1e-9)
    by_id = dict(x)
    ids = sorted(per_row)
    got = np.array([[per_row[i][c] for c in range(1, 17)] for i in ids])
    centred = np.array([[float(c - Fraction(s, n)) for c, s in zip(by_id[i], sums)] for i in ids])
    want = centred @ axes[:, :16] / np.sqrt(eigen[:16])
    signs = np.sign((got * want).sum(axis=0))
    assert np.allclose(got, want * signs, atol=1e-8)


def test_whitened_vectors_have_unit_covariance(spark):
    rows = spark.createDataFrame(vectors(n=300, dims=8), SCHEMA)
    x = whole(rows)
    model = fit(x)
    found = np.array([r["whitened"] for r in whiten(x, model).collect()])
    assert np.allclose(np.cov(found.T, bias=True), np.eye(8), atol=1e-10)


def test_variances_alone_give_every_covariance():
    rng = random.Random(5)
    z = [[rng.randint(-(10**k), 10**k) for k in (1, 5, 9, 18)] for _ in range(30)]
    n, dims = len(z), 4
    sums = tuple(sum(r[i] for r in z) for i in range(dims))
    squares = {(i, j): sum((r[i] + (r[j] if j > i else 0)) ** 2 for r in z) for i in range(dims) for j in range(i, dims)}
    want = [[n * sum(r[i] * r[j] for r in z) - sums[i] * sums[j] for j in range(dims)] for i in range(dims)]
    assert covariance(n, sums, squares) == want


def test_large_values_are_added_exactly(spark):
    rng = random.Random(6)
    values = [[rng.randint(-(10**15), 10**15), rng.randint(0, 9), 10**17 + k] for k in range(50)]
    x = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "vec_id long, x array<long>").repartition(3)
    model = fit(x)
    n = len(values)
    mean = [Fraction(sum(v[d] for v in values), n) for d in range(3)]
    trace = sum((v[d] - mean[d]) ** 2 for v in values for d in range(3)) / n
    assert model.trace == float(trace)
    found = whiten(x, model).collect()
    sums = [sum(v[d] for v in values) for d in range(3)]
    for r in found:
        exact = sum((n * c - s) ** 2 for c, s in zip(values[r["vec_id"]], sums))
        assert r["deviation"] == (exact if exact < 1 << 63 else None)


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(k, [1.0, 2.0], 0) for k in range(5)], [(1, [3.0], 0)]])
def test_nothing_to_whiten(spark, tmp_path, rows):
    found = op11_whitening(spark, folder(spark, tmp_path / "in", rows))
    assert found.collect() == []
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_copies_add_nothing(spark):
    rows = vectors(n=60, dims=6)
    once = fit(whole(spark.createDataFrame(rows, SCHEMA)))
    often = fit(whole(spark.createDataFrame(rows + [(1000 + k, rows[3][1], 0) for k in range(500)], SCHEMA)))
    assert once.n == often.n and once.rest == often.rest and np.array_equal(once.axes, often.axes)


def test_components_without_variance_are_left_out(spark, tmp_path):
    rows = [(k, [float(k % 7), float(k % 3), 4.0, float(k % 7)], 0) for k in range(50)]
    found = op11_whitening(spark, folder(spark, tmp_path / "in", rows)).collect()
    assert {r["component"] for r in found} == {1, 2}


def test_the_vectors_of_most_rows_count(spark):
    x = whole(spark.createDataFrame([(1, [1.0], 0), (2, [1.0, 2.0], 0), (3, [3.0, 4.0], 0)], SCHEMA))
    assert sorted(r["vec_id"] for r in x.collect()) == [2, 3]
    assert whitening.SCALE == 64
