import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cargolens.llm import neighbours
from cargolens.llm.neighbours import nearest_neighbours, op8_nearest_neighbours
from tests.llm.frames import folder

SCHEMA = "vec_id long, embedding array<float>, label int"


def vectors(n=300, dims=16, seed=1, norm=False):
    found = np.random.RandomState(seed).standard_normal((n, dims)).astype(np.float32)
    if norm:
        found /= np.linalg.norm(found, axis=1, keepdims=True)
    return [(i, [float(x) for x in v], 0) for i, v in enumerate(found)]


def brute(rows, nearest=20):
    good = [
        (i, np.array(v, float)) for i, v, _ in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    out = {}
    for i, v in good:
        if i % 20 == 0:
            found = sorted(((-float(v @ w), j) for j, w in good if j != i))[:nearest]
            out[i] = [(j, -s) for s, j in found]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def recall(found, want):
    assert found.keys() == want.keys()
    assert all(len(found[q]) == len(want[q]) for q in want)
    return np.mean([len({j for j, _ in found[q]} & {j for j, _ in want[q]}) / max(1, len(want[q])) for q in want])


def test_small_tables_are_exact(spark, tmp_path):
    rows = vectors()
    path = folder(spark.createDataFrame(rows, SCHEMA), tmp_path / "in", "embeddings")
    found, want = answers(op8_nearest_neighbours(spark, path)), brute(rows)
    assert recall(found, want) == 1
    for q in want:
        assert [j for j, _ in found[q]] == [j for j, _ in want[q]]
        assert np.allclose([s for _, s in found[q]], [s for _, s in want[q]], rtol=0, atol=1e-12)


@pytest.mark.parametrize("norm", [True, False])
def test_recall_where_blocks_are_small(spark, monkeypatch, norm):
    monkeypatch.setattr(neighbours, "BLOCK", 60)
    rows = vectors(1500, 24, norm=norm)
    docs = spark.createDataFrame(rows, SCHEMA)
    assert recall(answers(nearest_neighbours(docs, F.col("vec_id") % 20 == 0)), brute(rows)) >= 0.9


def test_copies_ties_and_rows_that_take_no_part(spark):
    rows = vectors(60, 8)
    same = rows[7][1]
    rows += [(100 + i, same, 0) for i in range(60)]
    rows += [(200, None, 0), (220, [0.0] * 8, 0), (240, [1.0] * 7 + [None], 0), (260, [math.nan] + [1.0] * 7, 0),
             (280, [math.inf] + [1.0] * 7, 0), (None, rows[3][1], 0), (300, [], 0)]
    rows.append(rows[5])
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS node", "'y' AS ids", "'z' AS q")
    once = [r for k, r in enumerate(rows) if r not in rows[:k]]
    found, want = answers(nearest_neighbours(docs, F.col("vec_id") % 20 == 0)), brute(once)
    assert {q: [j for j, _ in r] for q, r in found.items()} == {q: [j for j, _ in r] for q, r in want.items()}


@pytest.mark.parametrize("n", [0, 1, 5])
def test_tiny_tables(spark, n):
    rows = vectors(n, 4)
    found = answers(nearest_neighbours(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0))
    want = brute(rows)
    assert found == {q: r for q, r in found.items()} and {q: len(r) for q, r in found.items()} == {q: len(r) for q, r in want.items() if r}


def test_other_lengths_take_no_part(spark):
    rows = vectors(30, 4) + [(100 + i, [1.0, 2.0], 0) for i in range(5)]
    found = answers(nearest_neighbours(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 20 == 0))
    assert set(found) == {0, 20} and all(j < 100 for r in found.values() for j, _ in r)


@pytest.mark.parametrize("scale", [1e6, 1e-12, "one"])
def test_vectors_of_any_size_take_part(spark, scale):
    rows = vectors(300, 16, seed=4)
    if scale == "one":
        rows[7] = (7, [x * 1e6 for x in rows[7][1]], 0)
    else:
        rows = [(i, [float(np.float32(x * scale)) for x in v], k) for i, v, k in rows]
    docs = spark.createDataFrame(rows, SCHEMA)
    found, want = answers(nearest_neighbours(docs, F.col("vec_id") % 20 == 0)), brute(rows)
    assert recall(found, want) == 1
    assert all(math.isfinite(s) for r in found.values() for _, s in r)


def test_values_beyond_32_bits_take_part(spark):
    rows = [(i, [x * 1e60 for x in v], k) for i, v, k in vectors(100, 8)]
    docs = spark.createDataFrame(rows, SCHEMA.replace("float", "double"))
    assert recall(answers(nearest_neighbours(docs, F.col("vec_id") % 20 == 0)), brute(rows)) == 1


@pytest.mark.parametrize("near", [0.01, 0.003])
def test_recall_in_a_dense_group(spark, near):
    draws = np.random.RandomState(2)
    middle = draws.standard_normal(32)
    found = middle / np.linalg.norm(middle) + draws.standard_normal((1500, 32)) * near / 32**0.5
    found /= np.linalg.norm(found, axis=1, keepdims=True)
    rows = [(i, [float(np.float32(x)) for x in v], 0) for i, v in enumerate(found)]
    docs = spark.createDataFrame(rows, SCHEMA)
    share = recall(answers(nearest_neighbours(docs, F.col("vec_id") % 20 == 0)), brute(rows))
    print("recall", near, share)
    assert share >= 0.9
