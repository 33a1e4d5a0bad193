"""Declared schemas of every layer.  Nothing is inferred from data.

Order, customer and product identifiers are BIGINT: a table of the size this
library is meant for has more rows than a 32-bit integer can number.
"""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
ID = T.LongType()
INT = T.IntegerType()
SHORT = T.ShortType()
MONEY = T.DecimalType(12, 2)
RATE = T.DecimalType(8, 4)
COORDINATE = T.DecimalType(10, 6)
TIMESTAMP = T.TimestampNTZType()

# The 53 text columns of the raw export, in file order.
BRONZE_COLUMNS = """
    type days_for_shipping_real days_for_shipment_scheduled benefit_per_order
    sales_per_customer delivery_status late_delivery_risk category_id
    category_name customer_city customer_country customer_email customer_fname
    customer_id customer_lname customer_password customer_segment
    customer_state customer_street customer_zipcode department_id
    department_name latitude longitude market order_city order_country
    order_customer_id order_date order_id order_item_cardprod_id
    order_item_discount order_item_discount_rate order_item_id
    order_item_product_price order_item_profit_ratio order_item_quantity sales
    order_item_total order_profit_per_order order_region order_state
    order_status order_zipcode product_card_id product_category_id
    product_description product_image product_name product_price
    product_status shipping_date shipping_mode
""".split()

# Raw columns that never reach the cleaned table.
EXCLUDED_COLUMNS = [
    "customer_email",
    "customer_password",
    "order_zipcode",
    "product_description",
    "product_image",
    "product_status",
]

# Attribute lists of the dimensions, in target order.
CUSTOMER_ATTRIBUTES = [
    "customer_id", "customer_fname", "customer_lname", "customer_segment",
    "customer_city", "customer_state", "customer_country", "customer_zipcode",
    "latitude", "longitude",
]
PRODUCT_ATTRIBUTES = [
    "product_card_id", "product_name", "product_category_id", "category_id",
    "category_name", "department_id", "department_name", "product_price",
]
DESTINATION_ATTRIBUTES = [
    "order_city", "order_state", "order_country", "order_region", "market",
]
PROFILE_ATTRIBUTES = [
    "type", "order_status", "delivery_status", "shipping_mode",
    "late_delivery_risk",
]

# Columns of the fact table, in target order.
FACT_COLUMNS = [
    "order_item_id", "order_id",
    "customer_key", "product_key", "destination_key", "order_profile_key",
    "order_date_key", "shipping_date_key",
    "order_item_quantity",
    "sales", "sales_per_customer", "order_item_total",
    "order_item_product_price", "order_item_discount",
    "order_item_discount_rate",
    "benefit_per_order", "order_profit_per_order", "order_item_profit_ratio",
    "days_for_shipping_real", "days_for_shipment_scheduled",
]
FACT_NOT_NULL = FACT_COLUMNS[:8]

BRONZE = T.StructType([T.StructField(name, TEXT) for name in BRONZE_COLUMNS])

_TYPES = {
    **{name: ID for name in ("order_item_id", "order_id", "customer_id", "order_customer_id",
                             "product_card_id", "order_item_cardprod_id")},
    **{name: INT for name in ("days_for_shipping_real", "days_for_shipment_scheduled", "category_id",
                              "department_id", "order_item_quantity", "product_category_id",
                              "order_date_key", "shipping_date_key")},
    **{name: MONEY for name in ("benefit_per_order", "sales_per_customer", "order_item_discount",
                                "order_item_product_price", "sales", "order_item_total",
                                "order_profit_per_order", "product_price")},
    **{name: RATE for name in ("order_item_discount_rate", "order_item_profit_ratio")},
    **{name: COORDINATE for name in ("latitude", "longitude")},
    **{name: ID for name in ("customer_key", "product_key", "destination_key", "order_profile_key")},
    "late_delivery_risk": SHORT,
}


def struct(*names: str) -> T.StructType:
    """Fields of a cleaned or modelled table; columns not typed above are text."""
    return T.StructType([T.StructField(name, _TYPES.get(name, TEXT)) for name in names])


FACT = struct(*FACT_COLUMNS)
CALENDAR = T.StructType([
    T.StructField("date_key", INT),
    T.StructField("full_date", T.DateType()),
    T.StructField("year", INT),
    T.StructField("quarter", INT),
    T.StructField("month", INT),
    T.StructField("month_name", TEXT),
    T.StructField("week_of_year", INT),
    T.StructField("day", INT),
    T.StructField("day_name", TEXT),
    T.StructField("is_weekend", T.BooleanType()),
])
