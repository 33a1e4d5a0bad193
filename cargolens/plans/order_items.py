"""Order items and their raw export, derived from the sales tables of a folder.

``typed_items`` joins the tables into one typed row per order item.
``raw_export`` writes the same rows as the 53 text columns of an export, with
padding, mixed case, underscores, blanks and two date spellings, so that
profiling and cleaning have something to find.

Expressions that only rename or reshape input columns are SQL text, valid in
Spark and in ANSI engines alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cargolens.operators.joins import Lookup, fits_broadcast, hot_keys, lookup_join
from cargolens.operators.ranking import ranked_lookup
from cargolens.schemas import BRONZE_COLUMNS
from cargolens.workspace import Workspace

# Line items with exact numbers in place of doubles, in numbering order.
LINE_COLUMNS = {
    "l_orderkey": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "l_partkey": "l_partkey",
    "l_suppkey": "l_suppkey",
    "l_shipdate": "l_shipdate",
    "sales": "cast(l_extendedprice as decimal(12,2))",
    "quantity": "cast(l_quantity as int)",
    "discount": "cast(l_discount as decimal(4,2))",
    "tax": "cast(l_tax as decimal(4,2))",
    "l_returnflag": "l_returnflag",
    "l_linestatus": "l_linestatus",
}

_SCHEDULED = (
    "case o_orderpriority when '1-URGENT' then 0 when '2-HIGH' then 1 "
    "when '3-MEDIUM' then 2 else 4 end"
)
_REAL = "cast(o_orderkey % 7 as int)"
_STATUS = (
    "case when o_orderstatus = 'P' and o_orderkey % 5 = 0 then 'Shipping Canceled' "
    f"when {_REAL} > {_SCHEDULED} then 'Late Delivery' "
    f"when {_REAL} = {_SCHEDULED} then 'Shipping On Time' else 'Advance Shipping' end"
)
_PRICE = "cast(p_retailprice as decimal(12,2))"
_RATE = "cast(cast(discount as decimal(8,4)) * 3 as decimal(8,4))"
_PROFIT = (
    "cast(sales * (1 - discount) - cast(2.0 as decimal(2,1)) * quantity * "
    f"{_PRICE} as decimal(12,2))"
)
_CATEGORY = "cast(split_part(p_brand, '#', 2) as int)"


def _capitalised(column: str) -> str:
    return f"concat(substr({column}, 1, 1), lower(substr({column}, 2)))"


# One typed row per order item.  Times of day and the profit ratio are added
# separately, as engines spell them differently.
ITEM_COLUMNS = {
    "type": "case o_orderkey % 4 when 0 then 'Debit' when 1 then 'Transfer' "
            "when 2 then 'Payment' else 'Cash' end",
    "days_for_shipping_real": _REAL,
    "days_for_shipment_scheduled": _SCHEDULED,
    "delivery_status": _STATUS,
    "late_delivery_risk": f"cast(case when {_STATUS} = 'Late Delivery' then 1 else 0 end as smallint)",
    "category_id": _CATEGORY,
    "category_name": f"case {_CATEGORY} % 3 when 0 then concat('Women''S ', p_brand) "
                     "when 1 then concat('Indoor/Outdoor ', p_brand) else concat('École ', p_brand) end",
    "customer_city": "concat('Harbor ', cast(c_nationkey as string))",
    "customer_country": _capitalised("customer_nation"),
    "customer_fname": "split_part(c_name, '#', 1)",
    "customer_id": "c_custkey",
    "customer_lname": "split_part(c_name, '#', 2)",
    "customer_segment": _capitalised("c_mktsegment"),
    "customer_state": "concat('S', cast(c_nationkey as string))",
    "customer_street": "concat(cast(c_custkey as string), ' Quay Rd')",
    "customer_zipcode": "case when c_custkey % 7 = 0 then null "
                        "else cast(10000 + c_custkey % 90000 as string) end",
    "department_id": "cast(length(p_type) * 100 + ascii(p_type) as int)",
    "department_name": _capitalised("p_type"),
    "exact_latitude": "case when c_custkey % 13 = 0 then null "
                      "else cast(c_custkey % 90 as decimal(10,7)) + cast(0.1234567 as decimal(8,7)) end",
    "exact_longitude": "cast(-(c_custkey % 180) as decimal(10,7)) - cast(0.7654325 as decimal(8,7))",
    "market": "supplier_region",
    "order_city": "concat('City ', cast(l_suppkey as string))",
    "order_country": _capitalised("supplier_nation"),
    "order_customer_id": "c_custkey",
    "order_id": "l_orderkey",
    "order_item_cardprod_id": "l_partkey",
    "exact_discount": f"sales * {_RATE}",
    "order_item_discount_rate": _RATE,
    "order_item_id": "order_item_id",
    "order_item_product_price": _PRICE,
    "order_item_quantity": "quantity",
    "sales": "sales",
    "order_item_total": f"cast(sales - cast(sales * {_RATE} as decimal(12,2)) as decimal(12,2))",
    "order_profit_per_order": _PROFIT,
    "order_region": "supplier_region",
    "order_state": "concat('State ', cast(s_nationkey as string))",
    "order_status": "case o_orderstatus when 'P' then 'Pending Payment' "
                    "when 'F' then 'Complete' else 'On Hold' end",
    "product_card_id": "l_partkey",
    "product_category_id": _CATEGORY,
    "product_name": "p_name",
    "product_price": _PRICE,
    "shipping_mode": "case o_orderpriority when '1-URGENT' then 'Same Day' when '2-HIGH' then 'First Class' "
                     "when '3-MEDIUM' then 'Second Class' else 'Standard Class' end",
    "benefit_per_order": f"cast(case when l_returnflag = 'R' and l_linenumber = 3 then {_PROFIT} + 1 "
                         f"else {_PROFIT} end as decimal(12,2))",
    "sales_per_customer": "case when l_partkey % 11 = 0 then null else "
                          f"cast(sales - cast(sales * {_RATE} as decimal(12,2)) as decimal(12,2)) end",
    # Kept for spelling the raw text only.
    "l_linenumber": "l_linenumber",
    "l_suppkey": "l_suppkey",
    "p_brand": "p_brand",
    "customer_nation": "customer_nation",
    "supplier_nation": "supplier_nation",
    "c_mktsegment": "c_mktsegment",
    "p_type": "p_type",
}

# Taken from the customer's name once for a customer.
_OF_CUSTOMER = ["customer_fname", "customer_lname"]

_DIRTY = "(product_card_id + l_linenumber) % 5 = 0"


def _padded(text: str) -> str:
    return f"case when {_DIRTY} then concat('  ', {text}, ' ') else {text} end"


def _mixed_case(text: str) -> str:
    return f"case l_linenumber % 3 when 0 then upper({text}) when 1 then lower({text}) else {text} end"


def _digits(column: str) -> str:
    return f"cast({column} as string)"


# Raw spelling of each column; every one not listed is its typed value as text.
RAW_TEXT = {
    "type": _padded("upper(type)"),
    "days_for_shipment_scheduled": _padded(_digits("days_for_shipment_scheduled")),
    "sales_per_customer": f"coalesce({_digits('sales_per_customer')}, '')",
    "delivery_status": _padded(_mixed_case("delivery_status")),
    "category_name": _padded(_mixed_case("category_name")),
    "customer_city": _padded("lower(customer_city)"),
    "customer_country": "customer_nation",
    "customer_email": "'XXXXXXXXX'",
    "customer_fname": _padded("customer_fname"),
    "customer_id": _padded(_digits("customer_id")),
    "customer_password": "'XXXXXXXXX'",
    "customer_segment": "c_mktsegment",
    "customer_state": _padded("lower(customer_state)"),
    "customer_street": _padded("customer_street"),
    "customer_zipcode": "coalesce(customer_zipcode, '')",
    "department_name": "p_type",
    "latitude": f"coalesce({_digits('exact_latitude')}, '')",
    "longitude": _digits("exact_longitude"),
    "market": _padded("market"),
    "order_city": _padded("upper(order_city)"),
    "order_country": "supplier_nation",
    "order_item_discount": _padded(_digits("exact_discount")),
    "order_state": "lower(order_state)",
    "order_status": _padded("upper(replace(order_status, ' ', '_'))"),
    "order_zipcode": "case when product_card_id % 100 >= 14 then null "
                     "else cast(20000 + l_suppkey % 1000 as string) end",
    "product_description": "cast(null as string)",
    "product_image": "concat('https://images.example/', lower(replace(p_brand, '#', '')), '.jpg')",
    "product_name": _padded("product_name"),
    "product_status": "'0'",
    "shipping_mode": _padded(_mixed_case("shipping_mode")),
}


_PARTS = "parts_of_line"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _with_parts(rows: DataFrame, part: DataFrame, keys_from: DataFrame) -> DataFrame:
    """Each row once, with all parts of its key in one array, so that no row is lost or doubled."""
    found = part.groupBy("p_partkey").agg(
        F.collect_list(F.struct(*[name for name in part.columns if name != "p_partkey"])).alias(_PARTS)
    )
    lookup = Lookup(found, [("l_partkey", "p_partkey")])
    hot = [] if fits_broadcast(part) else hot_keys(keys_from, lookup.row_hash)
    return lookup.join(rows, hot, ["source_position"], "left").drop("p_partkey")


def typed_items(spark: SparkSession, folder: str, workspace: Workspace | None = None) -> DataFrame:
    """Typed order items.  Items are numbered 1..N in order and line sequence.

    Lines are shuffled for their parts, and once for their number and order together; an order
    has met its customer by then, and customers and suppliers their nations.  Tables that are
    broadcast come last, so nothing of them is shuffled.
    """
    lines = read_table(spark, folder, "lineitem").selectExpr(
        *[f"{expression} as {name}" for name, expression in LINE_COLUMNS.items()]
    )
    nation = read_table(spark, folder, "nation")
    region = read_table(spark, folder, "region")
    # Every looked-up table is a plain scan, so its size is known from its files, and so
    # is every table that hot keys are looked for in: no join runs twice for that.
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    customer = read_table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    supplier = read_table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    part = read_table(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    # A nation is looked up for a customer or a supplier, and not for each of their lines.
    of_customer = nation.select(
        F.col("n_nationkey").alias("customer_nationkey"), F.col("n_name").alias("customer_nation")
    )
    of_supplier = nation.select("n_nationkey", "n_regionkey", F.col("n_name").alias("supplier_nation"))
    customers = lookup_join(
        customer,
        of_customer,
        [("c_nationkey", "customer_nationkey")],
        spread_by=["c_custkey"],
    ).select("*", *[F.expr(ITEM_COLUMNS[name]).alias(name) for name in _OF_CUSTOMER]).drop("c_name", "customer_nationkey")
    suppliers = lookup_join(
        supplier,
        of_supplier,
        [("s_nationkey", "n_nationkey")],
        spread_by=["s_suppkey"],
    )
    suppliers = lookup_join(
        suppliers,
        region.select("r_regionkey", F.col("r_name").alias("supplier_region")),
        [("n_regionkey", "r_regionkey")],
        keys_from=nation,
        spread_by=["s_suppkey"],
    ).drop("n_nationkey", "n_regionkey", "r_regionkey")
    with_customers = lookup_join(
        orders,
        customers,
        [("o_custkey", "c_custkey")],
        spread_by=["o_orderkey"],
        sized_by=customer,
    )
    # Identical lines are interchangeable; their source position spreads them.
    sequence = [F.col(name).asc_nulls_last() for name in lines.columns]
    ranked = ranked_lookup(
        lines.withColumn("source_position", F.monotonically_increasing_id()),
        [*sequence, F.col("source_position")],
        "order_item_id",
        with_customers,
        "o_orderkey",
        attach=lambda rows: _with_parts(rows, part, lines),
    )
    joined = ranked.select("*", F.inline(_PARTS)).drop(_PARTS)
    joined = lookup_join(
        joined,
        suppliers,
        [("l_suppkey", "s_suppkey")],
        keys_from=lines,
        spread_by=["order_item_id"],
        sized_by=supplier,
    )

    profit, sales = F.expr(_PROFIT), F.col("sales")
    return joined.select(
        *[
            F.col(name) if name in _OF_CUSTOMER else F.expr(expression).alias(name)
            for name, expression in ITEM_COLUMNS.items()
        ],
        (profit / sales).cast("decimal(8,4)").alias("order_item_profit_ratio"),
        F.expr("timestampadd(MINUTE, o_orderkey % 1440, o_orderdate)").alias("order_timestamp"),
        F.expr("timestampadd(MINUTE, l_partkey % 1440, l_shipdate)").alias("shipping_timestamp"),
    )


def raw_export(items: DataFrame) -> DataFrame:
    """The 53 text columns of the export."""
    unpadded = F.col("order_id") % 2 == 0

    def spelled(moment: str):
        return F.when(unpadded, F.date_format(moment, "M/d/yyyy H:mm")).otherwise(
            F.date_format(moment, "MM/dd/yyyy HH:mm")
        )

    spelling = {name: F.expr(RAW_TEXT.get(name, _digits(name))) for name in BRONZE_COLUMNS
                if name not in ("order_date", "shipping_date")}
    spelling["order_date"] = spelled("order_timestamp")
    spelling["shipping_date"] = spelled("shipping_timestamp")
    return items.select(*[spelling[name].alias(name) for name in BRONZE_COLUMNS])
