"""The thirteen decision queries on the star schema.

Items count for profitability, orders for delivery.  Facts are aggregated by
surrogate key before they meet a dimension, so what is joined or ranked is
already small; margins are ratios of sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cargolens.functions.numbers import discount_band, mean, money, ratio, ratio_pct
from cargolens.operators.joins import lookup_join
from cargolens.operators.ranking import global_cumulative, global_ntile, top_k_share
from cargolens.operators.rollups import (
    PROFIT,
    SALES,
    loss_split,
    mean_parts,
    merge_loss_splits,
    one_row,
    order_rollup,
    schedule_variance,
    severity_counts,
    share_of_total,
    sum_where,
)
from cargolens.plans.star import Star
from cargolens.workspace import Workspace

# Delivery outcomes as cleaned.
LATE, ON_TIME, ADVANCE, CANCELED = (
    "Late Delivery", "Shipping On Time", "Advance Shipping", "Shipping Canceled",
)
# Names of the customer-value fifths, best first.
VALUE_GROUPS = ["Top 20%", "20-40%", "40-60%", "60-80%", "Bottom 20%"]


def _status(name: str) -> Column:
    return F.col("delivery_status") == name


def _with_profile(star: Star, *attributes: str) -> DataFrame:
    profile = star.profile.select("order_profile_key", *attributes)
    return lookup_join(
        star.fact, profile, ["order_profile_key"], keys_from=star.fact, spread_by=["order_item_id"]
    )


def _kept(star: Star, summary: DataFrame) -> DataFrame:
    """Write a small summary that is read more than once, so the fact is read once."""
    workspace = star.workspace or Workspace(summary.sparkSession)
    return workspace.materialize(summary, "summary")


def _losses_by(star: Star, *attributes: str) -> DataFrame:
    """Loss split per product attribute, added up per product key first."""
    per_product = loss_split(star.fact, "product_key")
    product = star.product.select("product_key", *attributes)
    return merge_loss_splits(lookup_join(per_product, product, ["product_key"], rows_unique=True), *attributes)


def product_losses(star: Star) -> DataFrame:
    """Products (by name) that lost money on some item, with the amount."""
    losses = _losses_by(star, "product_name").select("product_name", "negative_profit")
    return losses.where(F.col("negative_profit") < 0)


def _loss_order() -> list[Column]:
    return [F.col("negative_profit").asc_nulls_last(), F.col("product_name").asc_nulls_last()]


# Which of two grains a row of grouping sets belongs to: the first key is grouped away in
# the second set, and the other way round.
_BY_ORDER, _BY_PRODUCT = 1, 2


def _two_grains(rows: DataFrame, *keys: str) -> DataFrame:
    """Totals per order and totals per product in one scan, beneath the same ``keys``.

    ``grain`` tells them apart.  Rows of a task are added up per order and per product
    before they are shuffled, so the scan is what is saved.
    """
    loss = F.col(PROFIT) < 0
    order, product = [*keys, "order_id"], [*keys, "product_key"]
    sets = rows.groupingSets([order, product], *keys, "order_id", "product_key")
    last_two = F.grouping_id().bitwiseAND(F.lit(3))
    return sets.agg(
        last_two.cast("int").alias("grain"),
        F.count("*").alias("items"),
        F.count_if(loss).alias("loss_items"),
        F.sum(SALES).alias("sales"),
        F.sum("order_item_quantity").alias("units"),
        F.sum(PROFIT).alias("profit"),
        F.sum(F.when(loss, F.col(PROFIT)).otherwise(0)).alias("lost"),
        F.max("is_late").alias("is_late"),
    )


def _per_product(grains: DataFrame, *keys: str) -> DataFrame:
    """Orders added up to one row beneath ``keys``; one row per product stays."""
    return grains.groupBy(*keys, "grain", "product_key").agg(
        F.count("*").alias("groups"),
        F.sum("is_late").alias("late"),
        *[F.sum(name).alias(name) for name in ("items", "loss_items", "sales", "units", "profit", "lost")],
    )


def _of(grain: int, name: str) -> Column:
    return F.when(F.col("grain") == grain, F.col(name))


def executive_kpis(star: Star, top_products: int = 8) -> DataFrame:
    """One row of headline numbers.

    The fact is read once for totals per order, which the late rate needs, and for
    losses per product; what is read twice is their small summary.
    """
    rows = _with_profile(star, "delivery_status").select(
        "order_id", "product_key", SALES, PROFIT, "order_item_quantity",
        F.when(_status(LATE), 1).otherwise(0).alias("is_late"),
    )
    named = _per_product(_two_grains(rows)).join(
        star.product.select("product_key", "product_name"), "product_key", "left"
    )
    summed = ["groups", "late", "items", "loss_items", "sales", "profit", "lost"]
    summary = _kept(
        star, named.groupBy("grain", "product_name").agg(*[F.sum(name).alias(name) for name in summed])
    )

    totals = summary.agg(*[F.sum(_of(_BY_ORDER, name)).alias(name) for name in summed])
    total_orders = F.coalesce("groups", F.lit(0)).cast("long")
    total_items = F.coalesce("items", F.lit(0)).cast("long")
    headline = totals.select(
        money(F.col("sales")).alias("total_sales"),
        money(F.col("profit")).alias("net_profit"),
        ratio_pct(F.col("profit"), F.col("sales")).alias("profit_margin_pct"),
        total_orders.alias("total_orders"),
        total_items.alias("total_order_items"),
        ratio_pct(F.col("loss_items"), F.col("items")).alias("loss_making_item_rate_pct"),
        money(F.abs(F.col("lost"))).alias("total_negative_profit"),
        ratio_pct(F.col("late"), F.col("groups")).alias("late_delivery_rate_pct"),
    )
    losses = summary.where((F.col("grain") == _BY_PRODUCT) & (F.col("lost") < 0)).select(
        "product_name", F.col("lost").alias("negative_profit"), F.abs("lost").alias("loss")
    )
    share = f"top_{top_products}_negative_profit_share_pct"
    combined = one_row([headline, top_k_share(losses, "loss", top_products, _loss_order(), share)])
    *before, late = headline.columns
    return combined.select(*before, share, late)


def monthly_coverage(
    star: Star, first_month: tuple[int, int] = (2017, 8), last_month: tuple[int, int] = (2018, 12)
) -> DataFrame:
    """Product and category coverage per month, in one scan of the period.

    Date keys are ordered like dates, so the period is a range on the fact that reaches
    the file scan, and a month is the key without its day.
    """
    first, last = (year * 10000 + month * 100 for year, month in (first_month, last_month))
    month_of = lambda key: F.call_function("div", F.col(key), F.lit(100))
    rows = star.fact.where(F.col("order_date_key").between(first, last + 99)).select(
        month_of("order_date_key").alias("month_key"),
        "order_id", "product_key", SALES, PROFIT, "order_item_quantity", F.lit(0).alias("is_late"),
    )
    categories = star.product.select("product_key", "category_name")
    months = star.date.select(month_of("date_key").alias("month_key"), "year", "month", "month_name").distinct()
    coverage = (
        _per_product(_two_grains(rows, "month_key"), "month_key")
        .join(categories, "product_key", "left")
        .groupBy("month_key")
        .agg(
            F.sum(_of(_BY_PRODUCT, "groups")).alias("distinct_products"),
            F.count_distinct(_of(_BY_PRODUCT, "category_name")).alias("distinct_categories"),
            F.sum(_of(_BY_PRODUCT, "sales")).alias("sales"),
            F.sum(_of(_BY_PRODUCT, "units")).alias("units"),
            F.sum(_of(_BY_ORDER, "groups")).alias("orders"),
        )
    )
    return (
        coverage.join(months, "month_key")
        .select(
            "year",
            "month",
            "month_name",
            "distinct_products",
            "distinct_categories",
            ratio(F.col("sales"), F.col("units")).alias("sales_per_unit"),
            ratio(F.col("units"), F.col("orders")).alias("units_per_order"),
        )
        .orderBy("year", "month")
    )


def _loss_rate() -> Column:
    return ratio_pct(F.col("loss_making_items"), F.col("total_order_items"))


def loss_summary(star: Star) -> DataFrame:
    return loss_split(star.fact).select(
        "total_order_items",
        "loss_making_items",
        _loss_rate().alias("loss_making_item_rate_pct"),
        money(F.col("loss_making_sales")).alias("sales_from_loss_making_items"),
        ratio_pct(F.col("loss_making_sales"), F.col("total_sales")).alias("loss_making_sales_share_pct"),
        money(F.col("negative_profit")).alias("total_negative_profit"),
        money(F.col("positive_profit")).alias("positive_profit"),
        money(F.col("net_profit")).alias("net_profit"),
    )


def _reported_losses(losses: DataFrame, keys: list[str], least_items: int, measures: list[str]) -> DataFrame:
    kept = losses.where(F.col("total_order_items") >= least_items).select(
        *keys,
        "total_order_items",
        "loss_making_items",
        _loss_rate().alias("loss_making_item_rate_pct"),
        *[money(F.col(name)).alias(name) for name in measures],
    )
    return kept.orderBy(
        F.col("negative_profit").asc_nulls_last(), *[F.col(key).asc_nulls_last() for key in keys]
    )


def category_losses(star: Star, least_items: int = 200) -> DataFrame:
    measures = ["total_sales", "loss_making_sales", "negative_profit", "positive_profit", "net_profit"]
    return _reported_losses(_losses_by(star, "category_name"), ["category_name"], least_items, measures)


def worst_products(star: Star, least_items: int = 200, top: int = 20) -> DataFrame:
    keys = ["product_name", "category_name"]
    measures = ["total_sales", "loss_making_sales", "negative_profit", "net_profit"]
    return _reported_losses(_losses_by(star, *keys), keys, least_items, measures).limit(top)


def loss_concentration(star: Star) -> DataFrame:
    """Loss-making products in order of rank, with single and cumulative shares."""
    losses = product_losses(star).withColumn("loss", F.abs("negative_profit"))
    ranked = global_cumulative(losses, "loss", _loss_order(), "loss_rank", workspace=star.workspace)
    return ranked.select(
        "loss_rank",
        "product_name",
        money(F.col("negative_profit")).alias("negative_profit"),
        ratio_pct(F.col("loss"), F.col("grand_total")).alias("negative_profit_share_pct"),
        ratio_pct(F.col("running_total"), F.col("grand_total")).alias("cumulative_negative_profit_pct"),
    )


def _by_discount_band(star: Star) -> DataFrame:
    banded = star.fact.withColumn("discount_band", discount_band(F.col("order_item_discount_rate")))
    return banded.groupBy("discount_band").agg(
        F.min("order_item_discount_rate").alias("lowest_rate"),
        F.count("*").alias("total_order_items"),
        F.sum("order_item_quantity").alias("units_sold"),
        F.count_if(F.col(PROFIT) < 0).alias("loss_making_items"),
        F.sum(SALES).alias("total_sales"),
        sum_where(PROFIT, F.col(PROFIT) < 0).alias("negative_profit"),
        F.sum(PROFIT).alias("net_profit"),
    ).orderBy(F.col("lowest_rate").asc_nulls_last())


def discount_margin(star: Star) -> DataFrame:
    return _by_discount_band(star).select(
        "discount_band",
        F.col("total_order_items").alias("order_items"),
        "units_sold",
        money(F.col("total_sales")).alias("total_sales"),
        money(F.col("net_profit")).alias("total_profit"),
        ratio_pct(F.col("net_profit"), F.col("total_sales")).alias("profit_margin_pct"),
    )


def discount_loss_rate(star: Star) -> DataFrame:
    return _by_discount_band(star).select(
        "discount_band",
        "total_order_items",
        "loss_making_items",
        _loss_rate().alias("loss_making_item_rate_pct"),
        money(F.col("total_sales")).alias("total_sales"),
        money(F.col("negative_profit")).alias("negative_profit"),
        money(F.col("net_profit")).alias("net_profit"),
    )


def _orders(star: Star) -> DataFrame:
    keys = ["delivery_status", "shipping_mode"]
    return order_rollup(_with_profile(star, *keys), *keys)


def delivery_outcomes(star: Star) -> DataFrame:
    actual, scheduled = F.col("actual_shipping_days"), F.col("scheduled_shipping_days")
    outcomes = _orders(star).groupBy("delivery_status").agg(
        F.count("*").alias("total_orders"),
        F.sum("order_sales").alias("sales"),
        *mean_parts(actual, "actual"),
        *mean_parts(scheduled, "scheduled"),
        *mean_parts(schedule_variance(), "variance"),
    )
    shared = share_of_total(
        _kept(star, outcomes), {"total_orders": "order_share_pct", "sales": "sales_share_pct"}
    )
    return shared.select(
        "delivery_status",
        "total_orders",
        "order_share_pct",
        money(F.col("sales")).alias("total_sales"),
        "sales_share_pct",
        mean(F.col("actual_sum"), F.col("actual_count")).alias("avg_actual_shipping_days"),
        mean(F.col("scheduled_sum"), F.col("scheduled_count")).alias("avg_scheduled_shipping_days"),
        mean(F.col("variance_sum"), F.col("variance_count")).alias("avg_schedule_variance_days"),
    ).orderBy(F.desc("total_orders"), "delivery_status")


def shipping_mode_performance(star: Star) -> DataFrame:
    modes = _orders(star).groupBy("shipping_mode").agg(
        F.count("*").alias("total_orders"),
        F.count_if(_status(LATE)).alias("late_orders"),
        F.count_if(_status(ON_TIME)).alias("on_time_orders"),
        F.count_if(_status(ADVANCE)).alias("advance_orders"),
        F.count_if(_status(CANCELED)).alias("canceled_orders"),
        *mean_parts(schedule_variance(), "variance", F.col("delivery_status") != CANCELED),
        sum_where("order_sales", _status(LATE)).alias("late_sales"),
    )
    return modes.select(
        "shipping_mode",
        "total_orders",
        "late_orders",
        ratio_pct(F.col("late_orders"), F.col("total_orders")).alias("late_rate_pct"),
        "on_time_orders",
        "advance_orders",
        "canceled_orders",
        mean(F.col("variance_sum"), F.col("variance_count")).alias("avg_schedule_variance_days"),
        money(F.col("late_sales")).alias("late_order_sales"),
    ).orderBy(F.col("late_rate_pct").desc_nulls_first(), "shipping_mode")


def delay_severity(star: Star) -> DataFrame:
    """Late orders only; the filter applies to whole orders and is pushed down."""
    delay = F.col("delay_days")
    late = _orders(star).where(_status(LATE)).withColumn("delay_days", schedule_variance())
    modes = late.groupBy("shipping_mode").agg(
        F.count("*").alias("late_orders"),
        *severity_counts(delay),
        *mean_parts(delay, "delay"),
        F.max(delay).alias("max_delay_days"),
    )
    return modes.select(
        "shipping_mode",
        "late_orders",
        "one_day_late",
        "two_days_late",
        "three_plus_days_late",
        ratio_pct(F.col("severe_orders"), F.col("late_orders")).alias("severe_delay_rate_pct"),
        mean(F.col("delay_sum"), F.col("delay_count")).alias("avg_delay_days"),
        "max_delay_days",
    ).orderBy(F.col("avg_delay_days").desc_nulls_first(), "shipping_mode")


def _best_customers_first() -> list[Column]:
    return [F.col("total_profit").desc_nulls_first(), F.col("customer_id").asc()]


def customer_concentration(star: Star) -> DataFrame:
    """Customers in order of profit; the curve may pass 100 % before the losses."""
    per_customer = (
        star.fact.groupBy("customer_key", "order_id")
        .agg(F.sum(SALES).alias("sales"), F.sum(PROFIT).alias("profit"))
        .groupBy("customer_key")
        .agg(
            F.count("*").alias("total_orders"),
            F.sum("sales").alias("total_sales"),
            F.sum("profit").alias("total_profit"),
        )
    )
    names = star.customer.select("customer_key", "customer_id", "customer_fname", "customer_lname")
    customers = lookup_join(per_customer, names, ["customer_key"], rows_unique=True)
    ranked = global_cumulative(
        customers, "total_profit", _best_customers_first(), "profit_rank",
        running="cumulative_profit", total="company_profit", rows="total_customers",
        workspace=star.workspace,
    )
    return ranked.select(
        "profit_rank",
        "customer_id",
        F.concat("customer_fname", F.lit(" "), "customer_lname").alias("customer_name"),
        "total_orders",
        money(F.col("total_sales")).alias("total_sales"),
        money(F.col("total_profit")).alias("total_profit"),
        ratio_pct(F.col("profit_rank"), F.col("total_customers")).alias("cumulative_customer_pct"),
        ratio_pct(F.col("cumulative_profit"), F.col("company_profit")).alias("cumulative_profit_pct"),
    )


def service_by_customer_value(star: Star) -> DataFrame:
    """Delivery service per customer-value fifth.

    Orders are added up per customer, not joined to customers, so a customer
    with a large part of all orders is one row by the time it is ranked.
    """
    late, delay = _status(LATE), schedule_variance()
    per_customer = (
        order_rollup(_with_profile(star, "delivery_status"), "customer_key", "delivery_status")
        .groupBy("customer_key")
        .agg(
            F.sum("order_profit").alias("total_profit"),
            F.count("*").alias("orders"),
            F.count_if(late).alias("late"),
            *mean_parts(delay, "delay", late),
        )
    )
    ids = star.customer.select("customer_key", "customer_id")
    valued = global_ntile(
        lookup_join(per_customer, ids, ["customer_key"], rows_unique=True),
        len(VALUE_GROUPS),
        _best_customers_first(),
        "value_quintile",
        workspace=star.workspace,
    )
    label = F.element_at(F.array(*[F.lit(name) for name in VALUE_GROUPS]), F.col("value_quintile"))
    return (
        valued.groupBy("value_quintile")
        .agg(
            F.count("*").alias("customers"),
            F.sum("orders").alias("total_orders"),
            F.sum("late").alias("late_orders"),
            F.sum("delay_sum").alias("delay_sum"),
            F.sum("delay_count").alias("delay_count"),
        )
        .orderBy("value_quintile")
        .select(
            label.alias("customer_value_group"),
            "customers",
            "total_orders",
            "late_orders",
            ratio_pct(F.col("late_orders"), F.col("total_orders")).alias("late_rate_pct"),
            mean(F.col("delay_sum"), F.col("delay_count")).alias("avg_late_delay_days"),
        )
    )
