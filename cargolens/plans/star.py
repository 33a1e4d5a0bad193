"""The star schema: five dimensions, one fact row per order item."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from cargolens import schemas as S
from cargolens.functions.dates import calendar_columns, date_key
from cargolens.operators.joins import Lookup, fits_broadcast, lookup_joins, numbered_lookup, unmatched_keys
from cargolens.operators.ranking import assign_dense_key
from cargolens.workspace import Workspace


# What a table of keys or short attributes may take in memory to be broadcast.  The session's
# limit is meant for sizes of files, and gold tables know better.
MOST_BROADCAST = 128 << 20


@dataclass(frozen=True)
class Dimension:
    """Distinct attribute rows of the cleaned table under a surrogate key."""

    table: str
    key: str
    attributes: list[str]
    natural_key: list[str]
    unique: bool = False  # natural key is a business identifier: one version only

    @property
    def schema(self) -> T.StructType:
        return S.struct(self.key, *self.attributes)


CUSTOMER = Dimension("dim_customer", "customer_key", S.CUSTOMER_ATTRIBUTES, ["customer_id"], True)
PRODUCT = Dimension("dim_product", "product_key", S.PRODUCT_ATTRIBUTES, ["product_card_id"], True)
DESTINATION = Dimension(
    "dim_destination", "destination_key", S.DESTINATION_ATTRIBUTES, S.DESTINATION_ATTRIBUTES
)
PROFILE = Dimension(
    "dim_order_profile", "order_profile_key", S.PROFILE_ATTRIBUTES, S.PROFILE_ATTRIBUTES
)
DIMENSIONS = [CUSTOMER, PRODUCT, DESTINATION, PROFILE]


@dataclass(frozen=True)
class Star:
    """The written gold tables, and where reports on them may stage rows."""

    fact: DataFrame
    customer: DataFrame
    product: DataFrame
    destination: DataFrame
    profile: DataFrame
    date: DataFrame
    workspace: Workspace | None = None

    def dimension(self, spec: Dimension) -> DataFrame:
        return {
            CUSTOMER.table: self.customer,
            PRODUCT.table: self.product,
            DESTINATION.table: self.destination,
            PROFILE.table: self.profile,
        }[spec.table]


def build_dimension(silver: DataFrame, spec: Dimension, workspace: Workspace | None = None) -> DataFrame:
    """Distinct attribute rows, numbered 1..N in natural-key order."""
    distinct = silver.select(*spec.attributes).distinct()
    order = spec.natural_key + [name for name in spec.attributes if name not in spec.natural_key]
    return assign_dense_key(distinct, order, spec.key, workspace)


def date_bounds(silver: DataFrame) -> DataFrame:
    """First and last day over both timestamps, in one pass."""
    ordered, shipped = F.to_date("order_timestamp"), F.to_date("shipping_timestamp")
    return silver.agg(
        F.least(F.min(ordered), F.min(shipped)).alias("min_date"),
        F.greatest(F.max(ordered), F.max(shipped)).alias("max_date"),
    )


def build_calendar(silver: DataFrame) -> DataFrame:
    """One row per day between the bounds; no dates, no rows."""
    days = date_bounds(silver).select(F.explode(F.sequence("min_date", "max_date")).alias("full_date"))
    return days.select(*calendar_columns(F.col("full_date")))


def build_fact(
    silver: DataFrame,
    customer: DataFrame,
    product: DataFrame,
    destination: DataFrame,
    profile: DataFrame,
) -> DataFrame:
    """Look up four surrogate keys, compute two date keys, keep the measures.

    Keys of business identifiers number them in order, so a bitmap of the identifiers is enough.

    The dimensions must be written tables: their sizes decide how each lookup
    runs, and their keys must not be computed a second time.
    """
    measures = [name for name in S.FACT_COLUMNS if name in silver.columns]
    needed = {*measures, *S.DESTINATION_ATTRIBUTES, *S.PROFILE_ATTRIBUTES,
              "customer_id", "product_card_id", "order_timestamp", "shipping_timestamp"}
    rows = silver.select(*[name for name in silver.columns if name in needed])
    lookups = []
    for table, spec in ((profile, PROFILE), (destination, DESTINATION), (product, PRODUCT), (customer, CUSTOMER)):
        keys = table.select(spec.key, *spec.natural_key)
        found = None
        if spec.unique and not fits_broadcast(keys):
            found = numbered_lookup(rows, keys, *spec.natural_key, spec.key, MOST_BROADCAST)
        if found is None:
            lookups.append(Lookup(keys, spec.natural_key, MOST_BROADCAST))
        else:
            rows = found
    rows = lookup_joins(rows, lookups, keys_from=silver, spread_by=["order_item_id"])
    return rows.select(
        *measures[:2],
        "customer_key", "product_key", "destination_key", "order_profile_key",
        date_key(F.col("order_timestamp")).alias("order_date_key"),
        date_key(F.col("shipping_timestamp")).alias("shipping_date_key"),
        *measures[2:],
    ).select(*S.FACT_COLUMNS)


def unloadable_keys(silver: DataFrame, dimension: DataFrame, spec: Dimension) -> DataFrame:
    """Natural keys that would drop out of the fact load, with their row counts.

    A NULL in any key column matches nothing, as in the load itself.
    """
    return unmatched_keys(silver, dimension, spec.natural_key)


def _role(date: DataFrame, role: str) -> DataFrame:
    return date.select(
        F.col("date_key").alias(f"{role}_date_key"), F.col("full_date").alias(f"{role}_date")
    )


def star_view(star: Star, fact: DataFrame | None = None) -> DataFrame:
    """The fact with every dimension attached; the calendar plays two roles."""
    source = star.fact if fact is None else fact
    rows = source
    customer = star.customer.select(
        "customer_key", "customer_fname", "customer_lname", "customer_segment"
    )
    product = star.product.select("product_key", "product_name", "category_name", "department_name")
    destination = star.destination.select(
        "destination_key", "order_city", "order_country", "order_region", "market"
    )
    profile = star.profile.withColumnRenamed("type", "payment_type")
    lookups = [
        Lookup(profile, ["order_profile_key"]),
        Lookup(_role(star.date, "order"), ["order_date_key"]),
        Lookup(_role(star.date, "shipping"), ["shipping_date_key"]),
        Lookup(destination, ["destination_key"], MOST_BROADCAST),
        Lookup(product, ["product_key"]),
        Lookup(customer, ["customer_key"]),
    ]
    rows = lookup_joins(rows, lookups, keys_from=source, spread_by=["order_item_id"])
    return rows.select(
        "order_id", "order_item_id",
        "customer_fname", "customer_lname", "customer_segment",
        "product_name", "category_name", "department_name",
        "order_city", "order_country", "order_region", "market",
        "payment_type", "order_status", "delivery_status", "shipping_mode", "late_delivery_risk",
        "order_date", "shipping_date",
        "order_item_quantity", "sales", "order_item_total", "order_item_discount",
        "order_profit_per_order", "days_for_shipping_real", "days_for_shipment_scheduled",
    )


def star_sample(star: Star, limit: int = 50) -> DataFrame:
    """The first fact rows with all their attributes.

    The rows are picked before the joins: every key resolves (a release
    condition), so the joins neither add nor drop rows.
    """
    first = star.fact.orderBy("order_item_id").limit(limit)
    return star_view(star, first)
