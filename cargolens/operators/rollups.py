"""Aggregation building blocks shared by the analyses."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cargolens.functions.numbers import ratio_pct

PROFIT, SALES = "order_profit_per_order", "sales"


def sum_where(value: str | Column, condition: Column) -> Column:
    """Sum over matching rows; NULL when no row matches."""
    return F.sum(F.when(condition, F.col(value) if isinstance(value, str) else value))


def loss_split(df: DataFrame, *keys: str) -> DataFrame:
    """Item counts, sales and profit per group, split by the sign of profit."""
    loss = F.col(PROFIT) < 0
    return df.groupBy(*keys).agg(
        F.count("*").alias("total_order_items"),
        F.count_if(loss).alias("loss_making_items"),
        F.sum(SALES).alias("total_sales"),
        sum_where(SALES, loss).alias("loss_making_sales"),
        sum_where(PROFIT, loss).alias("negative_profit"),
        sum_where(PROFIT, F.col(PROFIT) >= 0).alias("positive_profit"),
        F.sum(PROFIT).alias("net_profit"),
    )


_SPLIT = [
    "total_order_items", "loss_making_items", "total_sales", "loss_making_sales",
    "negative_profit", "positive_profit", "net_profit",
]


def merge_loss_splits(split: DataFrame, *keys: str) -> DataFrame:
    """Add up the rows of ``loss_split`` into coarser groups."""
    return split.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in _SPLIT])


def order_rollup(items: DataFrame, *keys: str) -> DataFrame:
    """Order grain: sales added up, shipping days taken once per order."""
    return items.groupBy("order_id", *keys).agg(
        F.sum(SALES).alias("order_sales"),
        F.sum(PROFIT).alias("order_profit"),
        F.max("days_for_shipping_real").alias("actual_shipping_days"),
        F.max("days_for_shipment_scheduled").alias("scheduled_shipping_days"),
    )


def schedule_variance() -> Column:
    return F.col("actual_shipping_days") - F.col("scheduled_shipping_days")


def share_of_total(df: DataFrame, shares: Mapping[str, str]) -> DataFrame:
    """Add the percentage of each named column's grand total.

    ``df`` is read twice; pass a written table if it is costly to compute.
    """
    for value, name in shares.items():
        total = df.agg(F.sum(value).alias("total"))
        df = df.withColumn(name, ratio_pct(F.col(value), total.scalar()))
    return df


def mean_parts(value: Column, name: str, condition: Column | None = None) -> list[Column]:
    """Sum and count from which a mean can be taken after further grouping."""
    kept = value if condition is None else F.when(condition, value)
    return [F.sum(kept).alias(f"{name}_sum"), F.count(kept).alias(f"{name}_count")]


def severity_counts(delay: Column) -> list[Column]:
    """Late orders by days of delay."""
    return [
        F.count_if(delay == 1).alias("one_day_late"),
        F.count_if(delay == 2).alias("two_days_late"),
        F.count_if(delay >= 3).alias("three_plus_days_late"),
        F.count_if(delay >= 2).alias("severe_orders"),
    ]


def one_row(frames: Sequence[DataFrame]) -> DataFrame:
    """Put several one-row results side by side."""
    first, *rest = frames
    return first.select(
        "*",
        *[frame.select(name).scalar().alias(name) for frame in rest for name in frame.columns],
    )
