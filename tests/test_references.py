from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cargolens.operators.joins import unmatched_count
from cargolens.operators.references import Reference, known_keys, missing_references


def table(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "k int")


KEYS = {
    "dense": list(range(1, 300)),
    "repeated": [*range(5, 90), 7, 7, 8],
    "gaps": [k for k in range(-150, 700) if k % 7 and not 60 < k < 200],
    "ends of words": [0, 62, 63, 64, 125, 126, 127, 189, 10_000],
    "calendar": [y * 10000 + m * 100 + d for y in (1999, 2000) for m in range(1, 13) for d in range(1, 29)],
    "one": [4],
    "none": [],
    "null": [None, 3, 4, 9],
}


@pytest.mark.parametrize("most", [1 << 22, 4], ids=["bitmap", "join"])
def test_same_counts_as_anti_joins(spark, most):
    rng = random.Random(4)
    rows = [[rng.choice([None, 0, *range(-3, 12), 10**9, *(KEYS[n] or [1])]) for n in KEYS] for _ in range(800)]
    facts = spark.createDataFrame(rows, ", ".join(f"c{i} int" for i in range(len(KEYS))))
    refs = {f"missing {n}": Reference(f"c{i}", table(spark, KEYS[n]), "k") for i, n in enumerate(KEYS)}
    found = missing_references(facts, refs, F.count("*").alias("n"), most_bits=most).first().asDict()
    want = {n: unmatched_count(facts, r.table, [(r.key, "k")], "n").first()["n"] for n, r in refs.items()}
    assert found == {"n": 800} | want


def test_every_key_is_known_and_no_other(spark):
    refs = [Reference("k", table(spark, keys), "k") for keys in KEYS.values()]
    probe = spark.range(-200, 11_000).select("id")
    for keys, known in zip(KEYS.values(), known_keys(refs)):
        held = {r["id"] for r in probe.where(known.holds(F.col("id"))).collect()}
        assert held == {k for k in keys if k is not None and -200 <= k < 11_000}


def test_one_scan_and_no_shuffle_of_keys(spark, tmp_path):
    spark.range(1000).select(*[(F.col("id") % 50 + 1).cast("int").alias(f"c{i}") for i in range(6)]).write.parquet(
        str(tmp_path / "facts")
    )
    facts = spark.read.schema(", ".join(f"c{i} int" for i in range(6))).parquet(str(tmp_path / "facts"))
    refs = {f"m{i}": Reference(f"c{i}", table(spark, range(1, 51 - i)), "k") for i in range(6)}
    found = missing_references(facts, refs)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan and "hashpartitioning" not in plan
    assert [found.first()[f"m{i}"] for i in range(6)] == [20 * i for i in range(6)]
