from __future__ import annotations

import random

import pytest
from pyspark.sql import Window, functions as F

from cargolens.operators import ranking


def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "id long, v decimal(12,2)")


def cases():
    generator = random.Random(7)
    from decimal import Decimal

    money = lambda: Decimal(generator.randint(-500, 500)) / 100
    return {
        "ties": [money() for _ in range(997)],
        "one value for a third": [Decimal("1.00") if i % 3 == 0 else money() for i in range(900)],
        "nulls": [None if i % 4 == 0 else money() for i in range(400)],
        "all equal": [Decimal("2.00")] * 200,
        "three rows": [money() for _ in range(3)],
        "empty": [],
    }


@pytest.mark.parametrize("name", list(cases()))
@pytest.mark.parametrize("direction", ["asc_nulls_last", "desc_nulls_first"])
def test_global_order_equals_the_plain_window(spark, workspace, name, direction):
    size = 60 if direction == "asc_nulls_last" or name != "ties" else ranking.ROWS_PER_RANGE
    df = frame(spark, cases()[name]).repartition(5)
    order = [getattr(F.col("v"), direction)(), F.col("id").asc()]
    plain = Window.orderBy(*order)
    running = plain.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    expected = df.select(
        "id", "v",
        F.row_number().over(plain).cast("long").alias("n"),
        F.sum("v").over(running).alias("r"),
        F.sum("v").over(everything).alias("t"),
        F.count("*").over(everything).alias("c"),
    )
    got = ranking.global_cumulative(df, "v", order, "n", "r", "t", "c", workspace, size)
    assert [r["n"] for r in got.collect()] == list(range(1, len(cases()[name]) + 1))  # comes sorted
    assert sorted(got.collect()) == sorted(expected.collect()) if name != "nulls" else (
        sorted(map(repr, got.collect())) == sorted(map(repr, expected.collect()))
    )
    ranks = ranking.global_rank(df, order, "n", workspace=workspace, rows_per_range=size)
    assert sorted(ranks.select("id", "n").collect()) == sorted(expected.select("id", "n").collect())


@pytest.mark.parametrize("rows,buckets", [(0, 5), (1, 5), (3, 5), (5, 5), (7, 5), (100, 7), (101, 3)])
def test_global_ntile_equals_ntile(spark, workspace, rows, buckets):
    df = spark.range(rows).withColumn("v", F.pmod(F.xxhash64("id"), F.lit(50)))
    order = [F.col("v").desc(), F.col("id").asc()]
    got = ranking.global_ntile(df, buckets, order, "b", workspace, rows_per_range=20)
    expected = df.select("id", F.ntile(buckets).over(Window.orderBy(*order)).alias("b"))
    assert sorted(got.select("id", "b").collect()) == sorted(expected.collect())
    sizes = [r["count"] for r in got.groupBy("b").count().collect()]
    assert not sizes or max(sizes) - min(sizes) <= 1


def test_dense_keys_are_gapless_and_repeatable(spark, workspace):
    df = spark.range(500).select(
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("c"), F.col("id") % 100)).alias("city"),
        (F.col("id") % 37).alias("zip"),
    ).distinct()
    first = ranking.assign_dense_key(df, ["city", "zip"], "k", workspace, rows_per_range=30)
    again = ranking.assign_dense_key(df.repartition(3), ["city", "zip"], "k", workspace)
    keys = sorted(r["k"] for r in first.collect())
    assert keys == list(range(1, len(keys) + 1))
    assert sorted(map(repr, first.collect())) == sorted(map(repr, again.collect()))
    assert first.columns == ["k", "city", "zip"]


def test_ranges_share_the_rows_of_a_heavy_value(spark, workspace):
    """A value held by most rows must not end in one range, nor two ranges in one task."""
    df = spark.range(0, 200_000, 1, 8).select("id", F.lit(1).alias("v"))
    dealt = ranking._deal(df, [F.col("v").asc(), F.col("id").asc()], workspace, rows_per_range=20_000)
    tasks = dealt.rows.groupBy(F.spark_partition_id().alias("task")).agg(
        F.count("*").alias("n"), F.count_distinct("__range").alias("ranges")
    ).collect()
    assert len(tasks) == 4 and max(r["n"] for r in tasks) < 200_000 / 3
    assert {r["ranges"] for r in tasks} == {1} and sorted(dealt.counts) == sorted(r["n"] for r in tasks)


def test_mixed_keys_with_nulls_in_every_place(spark, workspace):
    rng = random.Random(3)
    values = [(rng.choice([None, "a", "b", "é"]), rng.choice([None, 1.5, float("nan"), -2.0]), k) for k in range(700)]
    df = spark.createDataFrame(values, "a string, b double, id long")
    order = [F.col("a").desc_nulls_last(), F.col("b").asc_nulls_first(), F.col("id").desc()]
    want = df.withColumn("n", F.row_number().over(Window.orderBy(*order))).select("id", "n").collect()
    got = ranking.global_rank(df, order, "n", workspace=workspace, rows_per_range=50).select("id", "n").collect()
    assert sorted(got) == sorted(want)


def test_keys_must_be_sorted_columns_of_the_input(spark, workspace):
    with pytest.raises(ValueError):
        ranking.global_rank(spark.range(3), [(F.col("id") % 2).asc()], workspace=workspace)


@pytest.mark.parametrize("size", [100, ranking.ROWS_PER_RANGE])
def test_a_table_is_exchanged_once_and_not_written(spark, workspace, size, tmp_path):
    spark.range(5000).select("id", (F.col("id") % 7).alias("v")).write.parquet(str(tmp_path / "t"))
    table = spark.read.schema("id long, v long").parquet(str(tmp_path / "t"))
    workspace.materialize = lambda *a: pytest.fail("the table was written again")
    order = [F.col("v").asc(), F.col("id").asc()]
    for got in (
        ranking.global_cumulative(table, "v", order, workspace=workspace, rows_per_range=size),
        ranking.global_ntile(table, 7, order, workspace=workspace, rows_per_range=size),
        ranking.assign_dense_key(table, ["v", "id"], "k", workspace, rows_per_range=size),
    ):
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1, plan


def test_no_single_task_window_over_the_rows(spark, workspace):
    """Unpartitioned windows may only see the per-range totals."""
    df = spark.range(1000).withColumn("v", F.col("id") % 10)
    got = ranking.global_cumulative(df, "v", [F.col("v").asc(), F.col("id").asc()], workspace=workspace, rows_per_range=100)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window" in line and "__range" not in line:
            assert "__n" in line, line


def test_top_k_share(spark):
    df = spark.createDataFrame([(1, 50), (2, 30), (3, 20)], "id long, v long")
    row = ranking.top_k_share(df, "v", 2, [F.col("v").desc()], "share").first()
    assert float(row["share"]) == 80.0
