"""How often and how wide the rows of the large tables are shuffled and written."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import Row, functions as F, types as T

from cargolens.operators import joins, ranking


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def lines_and_orders(spark):
    """A hot key, identical lines, keys without a match, NULL keys and a key that occurs twice."""
    lines = spark.range(600).select(
        F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 40).alias("k"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7).alias("n"),
    ).withColumn("at", F.monotonically_increasing_id())
    orders = spark.range(45).where("id % 9 <> 0").select(
        F.when(F.col("id") == 7, None).when(F.col("id") == 8, 10).otherwise(F.col("id")).alias("o"),
        F.concat(F.lit("order "), "id").alias("name"),
    )
    return lines, orders


@pytest.mark.parametrize("size", [20, ranking.ROWS_PER_RANGE])
def test_ranked_lookup_equals_a_rank_and_a_join(spark, workspace, no_broadcast, size):
    lines, orders = lines_and_orders(spark)
    path = workspace.fresh_path("lines")
    lines.drop("at").write.parquet(path)
    lines = spark.read.parquet(path).withColumn("at", F.monotonically_increasing_id())
    order = [F.col(name).asc_nulls_last() for name in ("k", "n", "at")]
    ranked = ranking.global_rank(lines, order, "item", workspace=workspace, rows_per_range=size)
    expected = ranked.join(orders, F.col("k") == F.col("o")).select("k", "n", "item", "name")
    attach = lambda rows: rows.withColumn("twice", F.col("n") * 2)
    got = ranking.ranked_lookup(lines, order, "item", orders, "o", attach, rows_per_range=size)
    assert got.where("twice <> n * 2").isEmpty()
    assert sorted(got.select("k", "n", "item", "name").collect()) == sorted(expected.collect())
    assert expected.count() > 400  # the doubled order and the hot key are in
    with pytest.raises(ValueError):
        ranking.ranked_lookup(lines, [F.col("k").desc(), *order[1:]], "item", orders, "o")


def test_lines_meet_their_order_where_they_are_numbered(spark, workspace, no_broadcast, monkeypatch):
    """Lines were shuffled once more for their order, and again with its columns for the customer."""
    from cargolens.plans import order_items

    real = order_items.ranked_lookup
    monkeypatch.setattr(order_items, "ranked_lookup", lambda *a, **b: real(*a, **b, rows_per_range=1000))
    items = order_items.typed_items(spark, "/root/testdata/sf0.001", workspace)
    plan = plan_of(items)
    assert len(re.findall(r"Exchange shufflepartitionidpassthrough", plan)) == 2  # lines, orders
    assert len(re.findall(r"Exchange hashpartitioning\(l_partkey", plan)) == 1
    assert not re.findall(r"Exchange hashpartitioning\((__range|l_orderkey|o_orderkey)", plan)
    # Orders meet their customers before the lines: deeper in the plan than the number.
    assert plan.index("Exchange hashpartitioning(o_custkey") > plan.index("row_number")


def test_items_keep_their_numbers_whatever_parts_they_have(spark, tmp_path, workspace):
    """A part that is lacking or occurs twice leaves the numbers of all lines alone."""
    from cargolens.plans.order_items import read_table, typed_items

    folder, source = str(tmp_path / "tables"), "/root/testdata/sf0.001"
    for name in ("lineitem", "orders", "customer", "supplier", "nation", "region"):
        read_table(spark, source, name).write.parquet(f"{folder}/{name}.parquet")
    part = read_table(spark, source, "part")
    part.where("p_partkey % 3 <> 0").unionByName(part.where("p_partkey % 3 = 1")).write.parquet(f"{folder}/part.parquet")
    whole = typed_items(spark, source, workspace).select("order_item_id", "product_card_id", "sales")
    copies = F.when(F.col("product_card_id") % 3 == 1, 2).when(F.col("product_card_id") % 3 == 2, 1).otherwise(0)
    expected = whole.withColumn("i", F.explode(F.array_repeat(F.lit(0), copies))).drop("i")
    got = typed_items(spark, folder, workspace).select("order_item_id", "product_card_id", "sales")
    assert sorted(got.collect()) == sorted(expected.collect())


def test_written_tables_are_packed_closely(spark, workspace, tmp_path):
    from cargolens.sources.layers import Layer

    rows = spark.range(10).select(F.col("id").cast("string").alias("name"))
    workspace.materialize(rows, "rows")
    Layer(spark, str(tmp_path), "bronze").load_once(rows, "rows", rows.schema)
    files = [*tmp_path.rglob("*.parquet")]
    assert len([f for f in files if "zstd" in f.name and f.is_file()]) == len([f for f in files if f.is_file()]) > 1


IDS = {
    "dense": list(range(1, 200)),
    "gaps": [*range(-70, 10), 62, 63, 64, 125, 126, 127, *range(500, 900, 7)],
    "far apart": [-(2**62), -63, -1, 0, 62, 2**40, 2**62],
    "none": [],
}


@pytest.mark.parametrize("name", list(IDS))
def test_a_bitmap_of_ids_gives_their_keys(spark, name):
    table = spark.createDataFrame([(i, n) for n, i in enumerate(IDS[name], start=1)], "id long, key long")
    asked = [None, -5, 11, 63, 64, 10**6, *IDS[name], *IDS[name][:3]]
    rows = spark.createDataFrame([(i, n) for n, i in enumerate(asked)], "id long, row int")
    if name == "none":
        assert joins.numbered_lookup(rows, table, "id", "key", 1 << 20) is None
        return
    got = joins.numbered_lookup(rows, table, "id", "key", 1 << 20)
    assert sorted(got.collect()) == sorted(rows.join(table, "id").select("id", "row", "key").collect())
    assert joins.numbered_lookup(rows, table, "id", "key", 64) is None  # takes more than that


@pytest.mark.parametrize("keys", [[1, 3, 2], [1, 2, 4], [1, None, 2], [1, 1, 2]])
def test_keys_that_do_not_number_their_ids_have_no_bitmap(spark, keys):
    table = spark.createDataFrame(list(zip([10, 11, 12], keys)), "id long, key long")
    assert joins.numbered_lookup(table, table, "id", "key", 1 << 20) is None
    twice = spark.createDataFrame([(10, 1), (10, 2)], "id long, key long")
    assert joins.numbered_lookup(twice, twice, "id", "key", 1 << 20) is None
    text = table.withColumn("id", F.col("id").cast("string"))
    assert joins.numbered_lookup(text, text, "id", "key", 1 << 20) is None


def test_the_fact_load_shuffles_no_fact_row(spark):
    """With tables beyond the session's limit, the rows were shuffled once for each."""
    from cargolens.plans import star as model
    from cargolens.registry import queries as registry

    folder = "/root/testdata/sf0.001"
    star, silver = registry.star(spark, folder), registry.silver(spark, folder)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        fact = model.build_fact(silver, star.customer, star.product, star.destination, star.profile)
        plan = plan_of(fact)
        assert "SortMergeJoin" not in plan and not re.findall(r"Exchange hashpartitioning\((?!__word)", plan)
        assert sorted(map(repr, fact.collect())) == sorted(map(repr, star.fact.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_what_is_broadcast_is_looked_up_last(spark, tmp_path):
    """Its text was shuffled with the rows."""
    def table(name, rows, text):
        path = str(tmp_path / name)
        spark.range(rows).select(F.col("id").alias(f"{name}_id"), F.lit(text).alias(f"{name}_text")).write.parquet(path)
        return spark.read.parquet(path)

    small, large = table("small", 10, "s"), table("large", 50_000, "l")
    facts = spark.range(1000).select((F.col("id") % 10).alias("a"), F.col("id").alias("b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(joins.plan_bytes(small)))
    try:
        lookups = [joins.Lookup(small, [("a", "small_id")]), joins.Lookup(large, [("b", "large_id")])]
        joined = joins.lookup_joins(facts, lookups)
        plan = plan_of(joined)
        assert plan.index("BroadcastHashJoin") < plan.index("SortMergeJoin")
        assert joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_nations_are_looked_up_for_customers_and_suppliers(spark, workspace, no_broadcast):
    """Every line was joined, and so shuffled, once for each nation and for the region."""
    from cargolens.plans import order_items

    plan = plan_of(order_items.typed_items(spark, "/root/testdata/sf0.001", workspace))
    found = [m.start() for m in re.finditer(r"Exchange hashpartitioning\((c_nationkey|s_nationkey|n_regionkey)", plan)]
    # Above the numbered lines there is only the join with suppliers.
    assert len(found) == 3 and min(found) > plan.index("row_number")


def test_dictionaries_of_written_tables_are_small(spark, workspace):
    """A megabyte for each of some fifty columns does not stay in a core's cache."""
    pq = pytest.importorskip("pyarrow.parquet")
    rows = spark.range(0, 60_000, 1, 1).select(F.sha2((F.col("id") % 6000).cast("string"), 256).alias("text"))
    written = workspace.materialize(rows, "texts")
    assert written.distinct().count() == 6000
    chunk = pq.ParquetFile(written.inputFiles()[0].removeprefix("file://")).metadata.row_group(0).column(0)
    assert chunk.data_page_offset - (chunk.dictionary_page_offset or chunk.data_page_offset) < 100_000


@pytest.mark.parametrize("inclusive", [True, False])
def test_range_numbers_of_keys_that_share_their_first_column_with_a_cut(spark, inclusive):
    cuts = [(2, 5), (4, None), (4, 1), (4, 7), (9, 0)]
    rows = [(a, b) for a in [None, 1, 2, 3, 4, 8, 9, 10] for b in [None, 0, 1, 5, 7, 9]]
    df = spark.createDataFrame(rows, "a long, b long")
    keys = [ranking._Key("a", False, False), ranking._Key("b", False, True)]
    place = lambda row: (row[0] is None, row[0] or 0, row[1] is not None, row[1] or 0)
    number = ranking._range_number(df, keys, [Row(a=a, b=b) for a, b in cuts], inclusive)
    got = {(r["a"], r["b"]): r["n"] for r in df.select("a", "b", number.alias("n")).collect()}
    reached = (lambda x, y: x >= y) if inclusive else (lambda x, y: x > y)
    assert got == {row: sum(reached(place(row), place(cut)) for cut in cuts) for row in rows}


def test_tables_that_add_little_are_looked_up_first(spark, tmp_path):
    """What they add is shuffled again with the rows for each table after them."""
    from cargolens.sources.layers import Layer

    layer = Layer(spark, str(tmp_path), "gold", measured=True)
    with layer.replaced():
        for name, text in (("wide", "w" * 50), ("narrow", "n")):
            table = spark.range(300).select(F.col("id").alias(f"{name}_id"), F.lit(text).alias(f"{name}_text"))
            layer.refresh(table, name, table.schema)
    wide, narrow = [layer.read(x, T.StructType().add(f"{x}_id", "long").add(f"{x}_text", "string")) for x in ("wide", "narrow")]
    path = str(tmp_path / "facts")
    spark.range(900).select((F.col("id") % 300).alias("a"), (F.col("id") % 200).alias("b")).write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        facts = spark.read.parquet(path)
        lookups = [joins.Lookup(wide, [("a", "wide_id")]), joins.Lookup(narrow, [("b", "narrow_id")])]
        joined = joins.lookup_joins(facts, lookups)
        plan = plan_of(joined)
        # The join at the top is the last one.
        assert plan.index("Exchange hashpartitioning(a") < plan.index("Exchange hashpartitioning(b")
        assert joined.where("wide_text LIKE 'w%' AND narrow_text = 'n'").count() == 900
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
