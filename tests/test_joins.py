from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from cargolens.operators import joins


@pytest.fixture(params=["10485760", "-1"], ids=["broadcast", "shuffled"])
def limit(spark, request):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_with_a_hot_key_and_missing_keys(spark, limit):
    rows = spark.range(3000).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None))
        .otherwise(F.col("id") % 1000).cast("int").alias("key"),
    )
    dimension = spark.range(900).select(F.col("id").alias("dim_id"), F.concat(F.lit("n"), "id").alias("name"))
    got = joins.lookup_join(rows, dimension, [("key", "dim_id")])
    expected = rows.join(dimension, F.col("key") == F.col("dim_id")).select("id", "key", "dim_id", "name")
    assert got.columns == ["id", "key", "dim_id", "name"]
    assert sorted(got.collect()) == sorted(expected.collect())


def test_lookup_on_several_columns_ignores_null_parts(spark, limit):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "a", None), (3, None, "x"), (4, "b", "y")], "id long, p string, q string")
    dimension = spark.createDataFrame([("a", "x", 10), ("a", None, 11), ("b", "z", 12)], "p string, q string, k int")
    got = joins.lookup_join(rows, dimension, ["p", "q"])
    assert [tuple(r) for r in got.collect()] == [(1, "a", "x", 10)]
    missing = joins.unmatched_keys(rows, dimension, ["p", "q"])
    assert sorted(map(repr, (tuple(r) for r in missing.collect()))) == sorted(
        map(repr, [("a", None, 1), (None, "x", 1), ("b", "y", 1)])
    )


def test_hot_keys_are_found_and_cut(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"))
    (wanted,) = rows.where("k = 5").select(F.xxhash64("k")).first()
    partitions = joins.shuffle_partitions(rows)
    assert joins.hot_keys(rows, F.xxhash64("k")) == [(wanted, math.ceil(10_001 * partitions * 4 / 30_000))]
    assert joins.hot_keys(rows.where("k < 0"), F.xxhash64("k")) == []


def test_no_task_receives_a_whole_hot_key(spark):
    """The piece is part of the shuffle key, and copies of one row spread too."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        rows = spark.range(30_000).select("id", F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"))
        dimension = spark.range(30_000).select(F.col("id").alias("k"), F.lit("d").alias("name"))
        joined = joins.lookup_join(rows, dimension, ["k"], spread_by=["id"])
        tasks = joined.groupBy(F.spark_partition_id()).agg(F.count_if(F.col("k") == 5).alias("n"))
        sizes = [r["n"] for r in tasks.collect()]
        assert sum(sizes) == 10_001 and max(sizes) < 4_000
        assert joined.count() == 30_000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_dimensions_below_the_limit_are_broadcast(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.range(100).select(F.col("id").alias("k"), F.lit("d").alias("name")).write.parquet(path)
    dimension = spark.read.schema("k long, name string").parquet(path)
    assert joins.fits_broadcast(dimension)
    rows = spark.range(1000).select(F.col("id").alias("k"))
    plan = joins.lookup_join(rows, dimension, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_hot_keys_are_not_looked_for_in_computed_rows(spark, tmp_path, monkeypatch):
    """No report and no build runs an aggregate or a join twice to look for hot keys."""
    from cargolens.plans import analyses, order_items
    from cargolens.registry import queries as registry

    seen = []
    real = joins.hot_keys_together

    def spied(rows, key_hashes):
        seen.append(rows._jdf.queryExecution().optimizedPlan().toString())
        return real(rows, key_hashes)

    folder = "/root/testdata/sf0.001"
    star = registry.star(spark, folder)
    monkeypatch.setattr(joins, "hot_keys_together", spied)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for report in (
            analyses.executive_kpis, lambda s: analyses.monthly_coverage(s, *registry.COVERAGE_PERIOD),
            analyses.category_losses, analyses.worst_products, analyses.loss_concentration,
            analyses.service_by_customer_value, analyses.customer_concentration,
        ):
            report(star)
        from cargolens.workspace import Workspace

        order_items.typed_items(spark, folder, Workspace(spark, str(tmp_path)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert seen and not [plan for plan in seen if "Aggregate" in plan or "Join" in plan]


def test_hot_keys_of_several_lookups_take_one_scan(spark, monkeypatch):
    """The fact load and the star view look for the hot keys of all their lookups at once."""
    from cargolens.plans import star as model
    from cargolens.registry import queries as registry

    folder = "/root/testdata/sf0.001"
    star, silver = registry.star(spark, folder), registry.silver(spark, folder)
    want = sorted(map(repr, model.star_view(star).collect()))
    calls = []
    real = joins.hot_keys_together

    def spied(rows, key_hashes):
        calls.append(len(key_hashes))
        return real(rows, key_hashes)

    monkeypatch.setattr(joins, "hot_keys_together", spied)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = model.build_fact(silver, star.customer, star.product, star.destination, star.profile)
        assert calls == [4]
        assert sorted(map(repr, fact.collect())) == sorted(map(repr, star.fact.collect()))
        view = model.star_view(star)
        assert calls == [4, 6]
        assert sorted(map(repr, view.collect())) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sketches_of_several_keys_are_one_aggregate(spark):
    rows = spark.range(9000).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("a"), (F.col("id") % 3000).alias("b")
    )
    a, b = joins.hot_keys_together(rows, [F.xxhash64("a"), F.xxhash64("b")])
    (hot,) = rows.where("a = 1").select(F.xxhash64("a")).first()
    assert [h for h, _ in a] == [hot] and b == []


def test_a_table_of_repeated_text_is_not_broadcast_by_its_file_size(spark, tmp_path):
    """Its files are a hundredth of what it takes in memory."""
    from cargolens.sources.layers import Layer

    layer = Layer(spark, str(tmp_path), "gold", measured=True)
    rows = spark.range(20_000).select(F.col("id").alias("k"), F.repeat(F.lit("Long name "), 30).alias("name"))
    with layer.replaced():
        layer.refresh(rows, "dim", rows.schema)
    dimension = layer.read("dim", rows.schema)
    assert joins.plan_bytes(dimension) < 1 << 20
    assert 20_000 * 300 < joins.memory_bytes(dimension) < 20_000 * 400
    assert joins.memory_bytes(dimension.select("k")) < 20_000 * 60
    facts = spark.range(50_000).select((F.col("id") % 20_000).alias("k"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(2 << 20))
    try:
        plan = joins.lookup_join(facts, dimension, ["k"])._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
        narrow = joins.lookup_join(facts, dimension.select("k"), ["k"])
        assert "BroadcastHashJoin" in narrow._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_what_is_derived_from_a_table_does_not_have_its_size(spark, tmp_path):
    from cargolens.sources.layers import Layer
    from cargolens.workspace import Workspace

    layer = Layer(spark, str(tmp_path), "gold", measured=True)
    rows = spark.range(10).select(F.col("id").alias("k"))
    with layer.replaced():
        layer.refresh(rows, "dim", rows.schema)
    dimension = layer.read("dim", rows.schema)
    many = dimension.join(spark.range(1000).select((F.col("id") % 10).alias("k")), "k").select("k")
    assert joins.memory_bytes(dimension) is not None and joins.memory_bytes(many) is None
    assert joins.memory_bytes(Workspace(spark, str(tmp_path / "w")).materialize(many, "many")) is None
