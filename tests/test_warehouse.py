from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cargolens import schemas as S
from cargolens.operators import profiling
from cargolens.operators.checks import ConstraintViolation
from cargolens.plans import analyses, quality, silver as cleaning, star as model
from cargolens.plans.warehouse import Warehouse
from tests.samples import raw, raw_frame


def warehouse(spark, tmp_path, *rows):
    house = Warehouse(spark, str(tmp_path / "house"))
    house.load_bronze(raw_frame(spark, *rows))
    return house


@pytest.fixture
def whole_stages(spark):
    name = "spark.sql.codegen.wholeStage"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    yield
    spark.conf.set(name, before)


def test_many_rules_are_not_compiled_into_one_method(spark, whole_stages):
    rows = raw_frame(spark, raw(), raw(order_item_quantity="many"))

    def compiled_as_one(df):
        plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
        return any("*(" in line for line in plan if "CASE WHEN" in line)

    few = cleaning.RULES[:2]
    assert compiled_as_one(cleaning.clean(rows, few)) and not compiled_as_one(cleaning.clean(rows))
    accepted, rest = cleaning.clean_or_quarantine(rows)
    plan = rest._jdf.queryExecution().executedPlan().toString()
    # Without generated code a filter of the array would interpret the rules.
    assert "array_remove" in plan and "filter(" not in plan
    assert accepted.count() == 1
    assert [r["broken_columns"] for r in rest.collect()] == [["order_item_quantity"]]


def test_cleaning_rules(spark):
    row = cleaning.clean(raw_frame(spark, raw())).first().asDict()
    assert len(row) == 47 and not set(S.EXCLUDED_COLUMNS) & set(row)
    wanted = {
        "type": "Debit", "delivery_status": "Advance Shipping", "category_name": "Women'S Apparel",
        "customer_fname": "Mirel", "customer_lname": "O'Brien", "customer_state": "PR",
        "customer_street": "12 Quay Lane East", "customer_zipcode": "04411", "market": "LATAM",
        "order_state": "North Coast", "order_status": "Pending Payment", "product_name": "Deck lamp",
        "sales_per_customer": Decimal("214.64"), "order_item_discount": Decimal("13.11"),
        "order_item_discount_rate": Decimal("0.0400"), "order_item_profit_ratio": Decimal("0.2900"),
        "latitude": Decimal("41.555124"), "longitude": Decimal("-12.037056"),
        "order_timestamp": dt.datetime(2018, 1, 31, 22, 56),
        "shipping_timestamp": dt.datetime(2018, 2, 3, 2, 6), "order_item_id": 904,
    }
    assert {name: row[name] for name in wanted} == wanted
    assert cleaning.clean(raw_frame(spark, raw())).schema.fieldNames() == cleaning.SILVER.fieldNames()


@pytest.mark.parametrize("column,value", [
    ("order_item_quantity", "3.0"), ("sales", "99999999999.99"), ("order_date", "2018-01-31"), ("order_id", "x"),
])
def test_unreadable_text_fails_or_is_set_aside(spark, column, value):
    rows = raw_frame(spark, raw(order_item_id="1"), raw(order_item_id="2", **{column: value}))
    with pytest.raises(Exception, match="cleaning rule failed"):
        cleaning.clean(rows).collect()
    accepted, rest = cleaning.clean_or_quarantine(rows)
    assert [r["order_item_id"] for r in accepted.collect()] == [1]
    target = "order_timestamp" if column == "order_date" else column
    assert [(r["order_item_id"], r["broken_columns"]) for r in rest.collect()] == [("2", [target])]


def test_import_is_not_repeated(spark, tmp_path):
    house = warehouse(spark, tmp_path, raw())
    with pytest.raises(Exception):
        house.load_bronze(raw_frame(spark, raw()))


def test_duplicate_item_and_long_text_block_silver(spark, tmp_path):
    with pytest.raises(ConstraintViolation, match="unique"):
        warehouse(spark, tmp_path / "a", raw(), raw()).build_silver()
    with pytest.raises(ConstraintViolation, match="max_length"):
        warehouse(spark, tmp_path / "b", raw(customer_zipcode="9" * 31)).build_silver()
    with pytest.raises(ConstraintViolation, match="not_null"):
        warehouse(spark, tmp_path / "c", raw(order_item_id=" ")).build_silver()


def test_two_versions_of_a_customer_block_gold(spark, tmp_path):
    house = warehouse(spark, tmp_path, raw(order_item_id="1"), raw(order_item_id="2", customer_zipcode="00999"))
    house.build_silver()
    versions = profiling.inconsistent_keys(house.bronze, "customer_id", ["customer_zipcode", "customer_city"])
    assert {r["column_name"]: r["varying_keys"] for r in versions.collect()} == {
        "customer_zipcode": 1, "customer_city": 0
    }
    with pytest.raises(ConstraintViolation, match="customer_id"):
        house.build_gold()


def test_a_failed_refresh_leaves_the_last_release(spark, tmp_path):
    house = warehouse(spark, tmp_path, raw(order_item_id="1"))
    house.build_silver()
    house.build_gold()
    # Later raw rows: first an item twice, then an item without a date.
    for later, error in ((raw(order_item_id="1"), "unique"), (raw(order_item_id="2", shipping_date=""), "shipping")):
        both = raw_frame(spark, raw(order_item_id="1"), later)
        both.select(*S.BRONZE.names).write.mode("overwrite").parquet(house.bronze_layer.path("order_items_raw"))
        with pytest.raises(ConstraintViolation, match=error):
            house.build_silver()
            house.build_gold()
        assert [r["order_item_id"] for r in house.star.fact.collect()] == [1]
        assert house.star.date.count() > 0
    assert house.silver.count() == 2 and len(house.gold_layer.versions()) == 1
    # A good refresh replaces both layers, and the version before last goes.
    raw_frame(spark, raw(order_item_id="5")).write.mode("overwrite").parquet(house.bronze_layer.path("order_items_raw"))
    for _ in range(3):
        house.build_silver()
        house.build_gold()
    assert [r["order_item_id"] for r in house.star.fact.collect()] == [5]
    assert len(house.gold_layer.versions()) == 2 == len(house.silver_layer.versions())
    house.register_views()
    assert spark.table("gold_fact_order_item").count() == 1


def test_null_destination_part_blocks_the_release(spark, tmp_path):
    house = warehouse(spark, tmp_path, raw(order_item_id="1"), raw(order_item_id="2", order_state=None))
    house.build_silver()
    with pytest.raises(ConstraintViolation, match="fact_rows"):
        house.build_gold()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):  # no fact is released
        house.star.fact.count()
    destination = model.build_dimension(house.silver, model.DESTINATION, house.workspace)
    lost = model.unloadable_keys(house.silver, destination, model.DESTINATION)
    assert [(r["order_state"], r["row_count"]) for r in lost.collect()] == [(None, 1)]


def test_blank_date_blocks_the_fact(spark, tmp_path):
    house = warehouse(spark, tmp_path, raw(order_item_id="1"), raw(order_item_id="2", shipping_date=""))
    house.build_silver()
    with pytest.raises(ConstraintViolation, match="shipping_date_key"):
        house.build_gold()


def test_reports_stage_below_the_warehouse_and_need_no_setting(spark, tmp_path, monkeypatch):
    """A warehouse with a root of its own works where no shared folder is set."""
    from cargolens import workspace
    from cargolens.plans import analyses

    house = warehouse(spark, tmp_path, raw(order_item_id="1", order_profit_per_order="-10"), raw(order_item_id="2"))
    house.build_silver()
    star = house.build_gold()

    def unset(_):
        raise ValueError("set spark.checkpoint.dir")

    monkeypatch.setattr(workspace, "shared_root", unset)
    for report in (analyses.executive_kpis, analyses.loss_concentration, analyses.delivery_outcomes,
                   analyses.customer_concentration, analyses.service_by_customer_value):
        assert report(star).collect()


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Five items in three orders of two customers; one product without a loss."""
    late = dict(delivery_status="LATE delivery", late_delivery_risk="1", days_for_shipping_real="6")
    rows = [
        raw(order_item_id="1", order_profit_per_order="-10", sales="100", order_item_discount_rate="0"),
        raw(order_item_id="2", order_profit_per_order="30", sales="50", order_item_discount_rate=""),
        raw(order_item_id="3", order_id="2", order_profit_per_order="5", sales="25", product_card_id="9",
            product_name="Boat", order_item_discount_rate="0.25", **late),
        raw(order_item_id="4", order_id="3", customer_id="8", order_profit_per_order="-40", sales="20",
            order_date="02/01/2018 00:00", **late),
        raw(order_item_id="5", order_id="3", customer_id="8", order_profit_per_order="0", sales="5",
            order_date="02/01/2018 00:00", **late),
    ]
    house = warehouse(spark, tmp_path_factory.mktemp("small"), *rows)
    house.build_silver()
    house.build_gold()
    return house


def test_star_is_complete(small):
    star = small.star
    assert star.fact.columns == S.FACT_COLUMNS and star.fact.count() == 5
    assert [r["full_date"] for r in star.date.orderBy("full_date").collect()] == [
        dt.date(2018, 1, 31), dt.date(2018, 2, 1), dt.date(2018, 2, 2), dt.date(2018, 2, 3)
    ]
    assert all(r["passed"] for r in quality.release_checks(small.silver, star).collect())
    assert model.star_view(star).count() == 5
    sample = model.star_sample(star, 2).collect()
    assert [r["order_item_id"] for r in sorted(sample, key=lambda r: r["order_item_id"])] == [1, 2]
    assert len(sample[0]) == 26


def test_views_answer_sql(spark, small):
    assert "gold_fact_order_item" in small.register_views()
    row = spark.sql(
        "select sum(f.sales) s from gold_fact_order_item f join gold_dim_customer c using (customer_key)"
    ).first()
    assert row["s"] == Decimal("200.00")


def test_small_results(small):
    star = small.star
    kpi = analyses.executive_kpis(star).first()
    assert (kpi["total_sales"], kpi["net_profit"], kpi["profit_margin_pct"]) == (
        Decimal("200.00"), Decimal("-15.00"), Decimal("-7.50"))
    assert (kpi["total_orders"], kpi["total_order_items"], kpi["late_delivery_rate_pct"]) == (3, 5, Decimal("66.67"))
    assert kpi["total_negative_profit"] == Decimal("50.00")
    assert kpi["top_8_negative_profit_share_pct"] == Decimal("100.00")

    # A product without a loss has no negative profit and sorts last.
    products = analyses.worst_products(star, least_items=1).collect()
    assert [(r["product_name"], r["negative_profit"]) for r in products] == [
        ("Deck lamp", Decimal("-50.00")), ("Boat", None)]
    assert len(analyses.worst_products(star, least_items=1, top=1).collect()) == 1
    assert [r["category_name"] for r in analyses.category_losses(star, 5).collect()] == ["Women'S Apparel"]
    assert analyses.category_losses(star).count() == 0

    # A missing rate counts as the deepest band; 0.25 still belongs to 20-25 %.
    bands = {r["discount_band"]: r["order_items"] for r in analyses.discount_margin(star).collect()}
    assert bands == {"0%": 1, "25%+": 1, "20-25%": 1, "0-5%": 2}

    curve = analyses.customer_concentration(star).collect()
    assert [(r["profit_rank"], r["customer_id"], r["total_orders"]) for r in curve] == [(1, 31007, 2), (2, 8, 1)]
    assert curve[-1]["cumulative_customer_pct"] == Decimal("100.00")
    assert curve[-1]["cumulative_profit_pct"] == Decimal("100.00")

    groups = analyses.service_by_customer_value(star).collect()
    assert [(r["customer_value_group"], r["customers"], r["late_orders"]) for r in groups] == [
        ("Top 20%", 1, 1), ("20-40%", 1, 1)]

    outcomes = analyses.delivery_outcomes(star).collect()
    assert sum(r["order_share_pct"] for r in outcomes) == Decimal("100.00")
    assert [r["delivery_status"] for r in outcomes] == ["Late Delivery", "Advance Shipping"]
    months = analyses.monthly_coverage(star, (2018, 2), (2018, 2)).collect()
    assert [(r["year"], r["month_name"], r["distinct_products"]) for r in months] == [(2018, "February", 1)]


def test_empty_tables_give_empty_or_null_results(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "none"))
    house.load_bronze(raw_frame(spark))
    house.build_silver()
    star = house.build_gold()
    assert star.date.count() == 0 and star.customer.count() == 0
    kpi = analyses.executive_kpis(star).first()
    assert (kpi["total_orders"], kpi["total_order_items"], kpi["total_sales"]) == (0, 0, None)
    for report in (analyses.loss_concentration, analyses.customer_concentration,
                   analyses.service_by_customer_value, analyses.delivery_outcomes):
        assert report(star).count() == 0


def test_profilers_on_few_rows(spark):
    rows = raw_frame(spark, raw(order_item_id="1"), raw(order_item_id="1", customer_lname=None), raw(order_item_id="3"))
    assert [tuple(r) for r in profiling.duplicate_keys(rows, "order_item_id").collect()] == [("1", 2)]
    # A missing name part reads as empty text and so counts as a version.
    versions = profiling.functional_dependency(rows, "customer_id", ["customer_fname", "customer_lname"], "v")
    assert [r["v"] for r in versions.collect()] == [2]
    ignored = profiling.functional_dependency(rows, "customer_id", ["customer_lname"], "v")
    assert ignored.count() == 0
    constants = {r["column_name"]: r["is_constant"] for r in profiling.constant_columns(rows, S.BRONZE_COLUMNS).collect()}
    assert constants["product_status"] and constants["product_description"] and not constants["order_item_id"]
    with pytest.raises(Exception, match="column sales"):
        profiling.numeric_range(raw_frame(spark, raw(sales="")), "sales", "a", "b").collect()
    assert profiling.distinct_sample(rows, "order_item_id", 1).first()[0] == "1"


def test_of_two_refreshes_the_later_to_finish_fails(spark, tmp_path):
    """It began before the other one was published, so it would take back what that one released."""
    from cargolens.sources.layers import Layer, RefreshConflict

    rows = spark.range(3).select(F.col("id").alias("k"))
    first, second = (Layer(spark, str(tmp_path), "gold") for _ in range(2))
    with pytest.raises(RefreshConflict):
        with first.replaced():
            first.refresh(rows, "t", rows.schema)
            with second.replaced():
                second.refresh(rows.limit(1), "t", rows.schema)
    assert first.read("t", rows.schema).count() == 1 and len(first.versions()) == 1
    assert len([p for p in (tmp_path / "gold").iterdir() if p.name.startswith("v")]) == 1
    # The next refresh starts from what was published.
    with first.replaced():
        first.refresh(rows, "t", rows.schema)
    assert second.read("t", rows.schema).count() == 3 and len(second.versions()) == 2


def test_the_release_reads_the_fact_twice(small):
    plan = quality.release_checks(small.silver, small.star)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("fact_order_item") == 2
    references = quality.missing_references(small.star)._jdf.queryExecution().executedPlan().toString()
    assert references.count("fact_order_item") == 1 and "Join" not in references
