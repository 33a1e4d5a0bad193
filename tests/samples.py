"""Small raw exports written out by hand."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cargolens.schemas import BRONZE, BRONZE_COLUMNS

GOOD = {
    "type": "DEBIT",
    "days_for_shipping_real": "3",
    "days_for_shipment_scheduled": "4",
    "benefit_per_order": "91.25",
    "sales_per_customer": "214.6400146",
    "delivery_status": "Advance shipping",
    "late_delivery_risk": "0",
    "category_id": "73",
    "category_name": "Women's apparel",
    "customer_city": "Harborton",
    "customer_country": "Northland",
    "customer_email": "XXXXXXXXX",
    "customer_fname": " Mirel ",
    "customer_id": "31007",
    "customer_lname": "O'brien",
    "customer_password": "XXXXXXXXX",
    "customer_segment": "Consumer",
    "customer_state": "pr",
    "customer_street": " 12 Quay Lane East",
    "customer_zipcode": "04411",
    "department_id": "2",
    "department_name": "Fitness",
    "latitude": "41.5551237",
    "longitude": "-12.03705597",
    "market": "LATAM",
    "order_city": "Portville",
    "order_country": "Southland",
    "order_customer_id": "31007",
    "order_date": "1/31/2018 22:56",
    "order_id": "5512",
    "order_item_cardprod_id": "77",
    "order_item_discount": "13.10999966",
    "order_item_discount_rate": "0.039999999",
    "order_item_id": "904",
    "order_item_product_price": "327.75",
    "order_item_profit_ratio": "0.289999992",
    "order_item_quantity": "1",
    "sales": "327.75",
    "order_item_total": "214.6400146",
    "order_profit_per_order": "91.25",
    "order_region": "Southeast Asia",
    "order_state": "north coast",
    "order_status": "PENDING_PAYMENT",
    "order_zipcode": None,
    "product_card_id": "77",
    "product_category_id": "73",
    "product_description": None,
    "product_image": "http://images.example/lamp.jpg",
    "product_name": "Deck lamp ",
    "product_price": "327.75",
    "product_status": "0",
    "shipping_date": "02/03/2018 02:06",
    "shipping_mode": "Standard Class",
}


def raw(**changes) -> dict:
    return {**GOOD, **changes}


def raw_frame(spark: SparkSession, *rows: dict) -> DataFrame:
    return spark.createDataFrame([tuple(row[name] for name in BRONZE_COLUMNS) for row in rows], BRONZE)
