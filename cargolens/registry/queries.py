"""Every operator and analysis as a named query over a folder of sales tables."""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from cargolens import schemas as S
from cargolens.functions.numbers import discount_band, mean, money, ratio_pct
from cargolens.functions.dates import date_key
from cargolens.operators import profiling as P
from cargolens.operators.joins import lookup_join
from cargolens.operators.ranking import global_cumulative, global_ntile, top_k_share
from cargolens.operators.rollups import (
    loss_split,
    mean_parts,
    order_rollup,
    schedule_variance,
    severity_counts,
    share_of_total,
)
from cargolens.plans import analyses as A, quality as Q, silver as C, star as G
from cargolens.plans.order_items import raw_export, typed_items
from cargolens.plans.warehouse import CLEAN, Warehouse
from cargolens.sources.csv_export import read_export, write_export
from cargolens.workspace import Workspace, shared_root

Query = Callable[[SparkSession, str], DataFrame]

# The period of the coverage report; the sales tables end in August 2001.
COVERAGE_PERIOD = ((2000, 8), (2001, 12))


@dataclass
class _Built:
    warehouse: Warehouse
    layers: set[str] = field(default_factory=set)


_built: dict[tuple, _Built] = {}
_lock = threading.RLock()


def _fingerprint(spark: SparkSession, folder: str) -> str:
    """Names, sizes and change times of the input files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    seen = sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files)
    return hashlib.sha1(repr((folder, seen)).encode()).hexdigest()[:12]


def _warehouse(spark: SparkSession, folder: str, *layers: str) -> Warehouse:
    """The warehouse of a folder, with the named layers built once per application."""
    app = spark.sparkContext.applicationId
    key = (app, _fingerprint(spark, folder))
    with _lock:
        if key not in _built:
            root = f"{shared_root(spark)}/cargolens-{app}/{key[1]}-{uuid.uuid4().hex[:8]}"
            _built[key] = _Built(Warehouse(spark, root))
        built = _built[key]
        warehouse = built.warehouse
        builders = {
            "bronze": lambda: warehouse.load_bronze(
                raw_export(typed_items(spark, folder, warehouse.workspace))
            ),
            "silver": warehouse.build_silver,
            "gold": warehouse.build_gold,
        }
        for layer in layers:
            if layer not in built.layers:
                builders[layer]()
                built.layers.add(layer)
        return warehouse


def bronze(spark: SparkSession, folder: str) -> DataFrame:
    return _warehouse(spark, folder, "bronze").bronze


def silver(spark: SparkSession, folder: str) -> DataFrame:
    return _warehouse(spark, folder, "bronze", "silver").silver


def star(spark: SparkSession, folder: str) -> G.Star:
    return _warehouse(spark, folder, "bronze", "silver", "gold").star


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the one numeric type all result readers share."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _on(source, build) -> Query:
    return lambda spark, folder: comparable(build(source(spark, folder)))


def _on_exact(source, build) -> Query:
    return lambda spark, folder: build(source(spark, folder))


def as_text(df: DataFrame) -> DataFrame:
    """Every value as text, so that each digit is compared."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def as_doubles(df: DataFrame) -> DataFrame:
    """Exact numbers written as text as doubles."""
    return df.select(*[c if c == "column_name" else F.col(c).cast("double").alias(c) for c in df.columns])


def _item_id() -> list:
    return [F.expr("try_cast(trim(order_item_id) as bigint)").asc_nulls_last()]


def _profiles() -> dict[str, Query]:
    def number(name: str):
        return P.numeric(name)

    def rounded(name: str):
        return F.round(number(name), 2)

    def sketched(d: DataFrame) -> DataFrame:
        """Whether sketches of parts, merged, come within three standard errors of the counts."""
        estimates = P.sketched_counts(P.distinct_sketches(d, SKETCHED_COLUMNS, "type"), SKETCHED_COLUMNS)
        exact = d.agg(*[F.count_distinct(c).alias(c) for c in SKETCHED_COLUMNS]).select(
            F.inline(F.array(*[
                F.struct(F.lit(c).alias("column_name"), F.col(c).alias("exact_values")) for c in SKETCHED_COLUMNS
            ]))
        )
        off = F.abs(F.col("distinct_values") - F.col("exact_values"))
        return estimates.join(exact, "column_name").select(
            "column_name", "exact_values",
            (off <= F.ceil(3 * F.col("standard_error") * F.col("exact_values"))).alias("is_close"),
        )

    builds = {
        "b01_row_count": lambda d: P.row_count(d),
        "b02_grain": lambda d: P.key_grain(d, "order_item_id", "distinct_order_items", "total_rows"),
        "b03_duplicate_keys": lambda d: P.duplicate_keys(d, "order_item_id"),
        "b04_distinct_orders": lambda d: P.key_grain(d, "order_id", "distinct_orders"),
        "b05_customer_id_mismatch": lambda d: P.column_mismatch(
            d, F.col("customer_id"), F.col("order_customer_id"), "mismatched_customer_ids"
        ),
        "b06_product_id_mismatch": lambda d: P.column_mismatch(
            d, F.col("product_card_id"), F.col("order_item_cardprod_id"), "mismatched_product_ids"
        ),
        "b07_null_order_zipcode": lambda d: P.null_profile(d, ["order_zipcode"]).drop("column_name"),
        "b08_null_description": lambda d: P.null_profile(d, ["product_description"]).select(
            "total_rows", "non_null_rows"
        ),
        "b09_product_status": lambda d: P.value_frequency(d, "product_status"),
        "b09_constant_columns": lambda d: P.constant_columns(d, S.BRONZE_COLUMNS),
        "b10_email_sample": lambda d: P.distinct_sample(d, "customer_email"),
        "b11_password_rows": lambda d: P.populated_rows(d, "customer_password", "populated_password_rows"),
        "b12_image_sample": lambda d: P.distinct_sample(d, "product_image"),
        "b13_freq_delivery_status": lambda d: P.value_frequency(d, "delivery_status"),
        "b14_freq_late_risk": lambda d: P.value_frequency(d, "late_delivery_risk", by_value=True),
        "b15_freq_segment": lambda d: P.value_frequency(d, "customer_segment"),
        "b16_freq_market": lambda d: P.value_frequency(d, "market"),
        "b17_freq_order_status": lambda d: P.value_frequency(d, "order_status"),
        "b18_freq_shipping_mode": lambda d: P.value_frequency(d, "shipping_mode"),
        "b19_freq_type": lambda d: P.value_frequency(d, "type"),
        "b20_distinct_customers": lambda d: P.key_grain(d, "customer_id", "distinct_customers"),
        "b21_fd_customer_name": lambda d: P.functional_dependency(
            d, "customer_id", ["customer_fname", "customer_lname"], "name_versions"
        ),
        "b22_fd_customer_location": lambda d: P.functional_dependency(
            d, "customer_id", ["customer_city", "customer_state", "customer_country"], "location_versions"
        ),
        "b23_distinct_products": lambda d: P.key_grain(d, "product_card_id", "distinct_products"),
        "b24_fd_product_name": lambda d: P.functional_dependency(
            d, "product_card_id", ["product_name"], "product_name_versions"
        ),
        "b25_fd_product_category": lambda d: P.functional_dependency(
            d, "product_card_id", ["product_category_id"], "category_versions"
        ),
        "b26_fd_category_name": lambda d: P.functional_dependency(
            d, "category_id", ["category_name"], "category_name_versions"
        ),
        "b27_fd_department_name": lambda d: P.functional_dependency(
            d, "department_id", ["department_name"], "department_name_versions"
        ),
        "b35_range_discount_rate": lambda d: as_doubles(P.numeric_range(
            d, "order_item_discount_rate", "min_discount_rate", "max_discount_rate"
        )),
        "b36_range_profit_ratio": lambda d: as_doubles(P.numeric_range(
            d, "order_item_profit_ratio", "min_profit_ratio", "max_profit_ratio"
        )),
        "b37_negative_profit": lambda d: P.predicate_counts(
            d, negative_profit_rows=number("order_profit_per_order") < 0
        ),
        "b38_zero_quantity": lambda d: P.predicate_counts(
            d, zero_quantity_rows=number("order_item_quantity") == 0
        ),
        "b39_negative_quantity": lambda d: P.predicate_counts(
            d, negative_quantity_rows=number("order_item_quantity") < 0
        ),
        "b40_negative_sales": lambda d: P.predicate_counts(d, negative_sales_rows=number("sales") < 0),
        "b41_money_sample": lambda d: P.row_sample(
            d,
            ["sales", "sales_per_customer", "order_item_total", "benefit_per_order", "order_profit_per_order"],
            _item_id(), 50,
        ),
        "b42_sales_vs_total": lambda d: P.column_mismatch(
            d, rounded("sales"), rounded("order_item_total"), "different_rows"
        ),
        "b43_benefit_vs_profit": lambda d: P.column_mismatch(
            d, rounded("benefit_per_order"), rounded("order_profit_per_order"), "different_rows"
        ),
        "b44_date_sample": lambda d: P.row_sample(d, ["order_date", "shipping_date"], _item_id(), 20),
        "b45_order_dates": lambda d: P.timestamp_range(
            d, "order_date", "earliest_order_date_raw", "latest_order_date_raw"
        ),
        "b46_shipping_dates": lambda d: P.timestamp_range(
            d, "shipping_date", "earliest_shipping_date_raw", "latest_shipping_date_raw"
        ),
        "b47_ws_product_name": lambda d: P.whitespace(d, product_names_with_spaces="product_name"),
        "b48_ws_first_name": lambda d: P.whitespace(d, customer_first_names_with_spaces="customer_fname"),
        "b49_ws_last_name": lambda d: P.whitespace(d, customer_last_names_with_spaces="customer_lname"),
        "b50_ws_order_status": lambda d: P.whitespace(d, order_status_with_spaces="order_status"),
        # Several profiles fused into one pass over the table.
        "b07_null_profile_all": lambda d: P.null_profile(d, S.BRONZE_COLUMNS),
        "b28_numeric_profile_all": lambda d: as_doubles(P.numeric_profile(d, RANGE_COLUMNS)),
        "b28_exact_ranges": lambda d: P.numeric_profile(d, RANGE_COLUMNS),
        "b02_sketched_counts": sketched,
        "b21_attribute_versions": lambda d: P.inconsistent_keys(
            d, "order_customer_id", S.CUSTOMER_ATTRIBUTES[1:]
        ),
    }
    for name, (column, label) in RANGES.items():
        builds[name] = lambda d, column=column, label=label: as_doubles(P.numeric_range(
            d, column, f"min_{label}", f"max_{label}", f"avg_{label}"
        ))
    return {name: _on(bronze, build) for name, build in builds.items()}


# Numeric range reports: query name -> raw column and label.
RANGES = {
    "b28_range_shipping_days": ("days_for_shipping_real", "shipping_days"),
    "b29_range_scheduled_days": ("days_for_shipment_scheduled", "scheduled_days"),
    "b30_range_benefit": ("benefit_per_order", "benefit"),
    "b31_range_sales": ("sales", "sales"),
    "b32_range_item_total": ("order_item_total", "order_item_total"),
    "b33_range_profit": ("order_profit_per_order", "order_profit"),
    "b34_range_quantity": ("order_item_quantity", "quantity"),
}
RANGE_COLUMNS = [column for column, _ in RANGES.values()] + [
    "order_item_discount_rate", "order_item_profit_ratio",
]

SKETCHED_COLUMNS = ["order_item_id", "order_id", "customer_id", "product_card_id"]

# Cleaning rules shown one by one: query name -> rules.
CLEANING_SUBSETS = {
    "s01_title_case": C.rules_of(C.TITLE),
    "s02_status": C.rules_of(C.STATUS),
    "s03_upper": C.rules_of(C.UPPER),
    "s04_trim": C.rules_of(C.KEEP),
    "s05_zipcode": C.rules_of(C.BLANK_NULL),
    "s06_int": C.rules_of(C.TYPED, S.ID, S.INT),
    "s07_smallint": C.rules_of(C.TYPED, S.SHORT),
    "s08_money": C.rules_of(C.TYPED, S.MONEY),
    "s09_rate": C.rules_of(C.TYPED, S.RATE),
    "s10_coordinates": C.rules_of(C.TYPED, S.COORDINATE),
    "s11_timestamp": C.rules_of(C.MOMENT),
}


def _cleaning() -> dict[str, Query]:
    item = C.rules_of(C.TYPED, S.ID)
    item = [rule for rule in item if rule.target == "order_item_id"]

    def subset(rules):
        rest = [rule for rule in rules if rule.target != "order_item_id"]
        return lambda d: C.clean(d, item + rest)

    def preserved(spark: SparkSession, folder: str) -> DataFrame:
        kept = P.row_count(silver(spark, folder), "silver_rows")
        return P.row_count(bronze(spark, folder), "bronze_rows").select(
            "bronze_rows", kept.scalar().alias("silver_rows")
        )

    def written(spark: SparkSession, folder: str) -> DataFrame:
        """The cleaned table as its files have it, not as it is declared."""
        warehouse = _warehouse(spark, folder, "bronze", "silver")
        return spark.read.parquet(warehouse.silver_layer.path(CLEAN))

    def excluded(spark: SparkSession, folder: str) -> DataFrame:
        """Which of the excluded columns the written table holds, beside its rows."""
        table = written(spark, folder)
        names = F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.lit(c in table.columns).alias("is_written"))
            for c in S.EXCLUDED_COLUMNS
        ])
        return table.agg(F.count("*").alias("rows")).select("rows", F.inline(names))

    def written_columns(spark: SparkSession, folder: str) -> DataFrame:
        """Place, name, type and number of values of each written column."""
        table = written(spark, folder)
        places = F.create_map(*[
            F.lit(x) for i, f in enumerate(table.schema, start=1)
            for x in (f.name, f"{i} {f.dataType.simpleString()}")
        ])
        counts = P.null_profile(table, table.columns)
        return counts.select("column_name", places[F.col("column_name")].alias("place"), "non_null_rows")

    def exact_decimals(d: DataFrame) -> DataFrame:
        """Every decimal as text, so that types and digits are compared."""
        exact = [f.name for f in d.schema if isinstance(f.dataType, T.DecimalType)]
        return d.select("order_item_id", *[F.col(c).cast("string").alias(c) for c in exact])

    found = {name: _on(bronze, subset(rules)) for name, rules in CLEANING_SUBSETS.items()}
    found["s_clean"] = _on(bronze, C.clean)
    found["s12_excluded_in_bronze"] = _on(bronze, lambda d: P.null_profile(d, S.EXCLUDED_COLUMNS))
    found["s12_excluded_columns"] = excluded
    found["io6_written_columns"] = written_columns
    found["s_exact_decimals"] = _on_exact(silver, exact_decimals)
    found["s13_row_preservation"] = preserved
    return found


def _with_silver_and_star(build) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        gold = star(spark, folder)
        return comparable(build(silver(spark, folder), gold))

    return run


def _lookup(spec: G.Dimension) -> Query:
    """Item ids with the natural key that their surrogate key stands for."""

    def build(gold: G.Star) -> DataFrame:
        table = gold.dimension(spec).select(spec.key, *spec.natural_key)
        rows = gold.fact.select("order_item_id", spec.key)
        return lookup_join(rows, table, [spec.key])

    return _on(star, build)


def _model() -> dict[str, Query]:
    def gold_counts(gold: G.Star) -> DataFrame:
        tables = {"fact_order_item": gold.fact, "dim_date": gold.date}
        tables.update({spec.table: gold.dimension(spec) for spec in G.DIMENSIONS})
        counted = [
            P.row_count(frame).select(F.lit(name).alias("table_name"), "total_rows")
            for name, frame in tables.items()
        ]
        return Q.checks.union_all(counted)

    def dense_key_summary(gold: G.Star) -> DataFrame:
        return Q.checks.union_all([
            gold.dimension(spec).agg(
                F.min(spec.key).alias("lowest_key"),
                F.max(spec.key).alias("highest_key"),
                F.count("*").alias("total_rows"),
                F.count_distinct(spec.key).alias("distinct_keys"),
            ).select(F.lit(spec.table).alias("table_name"), "*")
            for spec in G.DIMENSIONS
        ])

    def date_keys(rows: DataFrame) -> DataFrame:
        return rows.select(
            "order_item_id",
            date_key(F.col("order_timestamp")).alias("order_date_key"),
            date_key(F.col("shipping_timestamp")).alias("shipping_date_key"),
        )

    found = {
        "g01_dim_customer": _on(star, lambda s: s.customer),
        "g02_dim_product": _on(star, lambda s: s.product),
        "g03_dim_destination": _on(star, lambda s: s.destination),
        "g04_dim_order_profile": _on(star, lambda s: s.profile),
        "g05_date_bounds": _on(silver, G.date_bounds),
        "g06_dim_date": _on(star, lambda s: s.date),
        "g07_dense_key": _on(star, dense_key_summary),
        "g08_fact": _on(star, lambda s: s.fact),
        "g09_customer_lookup": _lookup(G.CUSTOMER),
        "g10_product_lookup": _lookup(G.PRODUCT),
        "g11_destination_lookup": _lookup(G.DESTINATION),
        "g12_profile_lookup": _lookup(G.PROFILE),
        "g13_date_key": _on(silver, date_keys),
        "c01_calendar_coverage": _on(star, Q.calendar_coverage),
        "c02_missing_order_dates": _with_silver_and_star(
            lambda d, s: Q.missing_dates(d, s, "order_timestamp", "missing_order_date")
        ),
        "c02b_missing_shipping_dates": _with_silver_and_star(
            lambda d, s: Q.missing_dates(d, s, "shipping_timestamp", "missing_shipping_date")
        ),
        "c03_reconciliation": _with_silver_and_star(Q.reconciliation),
        "c04_fact_grain": _on(star, Q.fact_grain),
        "c16_star_view": _on(star, G.star_view),
        "c16_star_sample": _on(star, G.star_sample),
        "c17_violations": _with_silver_and_star(Q.all_violations),
        "c18_release_checks": _with_silver_and_star(Q.release_checks),
        "c19_order_consistency": _on(silver, Q.order_consistency),
        "io4_gold_tables": _on(star, gold_counts),
    }
    for number, name in enumerate(COUNTED, start=5):
        found[f"c{number:02d}_{name}"] = _on(star, lambda s, name=name: Q.dimension_counts(s)[name])
    for number, name in enumerate(REFERENCES, start=10):
        found[f"c{number:02d}_{name}"] = _on(star, lambda s, name=name: Q.missing_reference(s, name))
    found["c10_missing_references"] = _on(star, Q.missing_references)
    return found


COUNTED = ["customers", "products", "destinations", "order_profiles", "dates"]
REFERENCES = [
    "missing_customers", "missing_products", "missing_destinations",
    "missing_order_profiles", "missing_order_dates", "missing_shipping_dates",
]


def _analyses() -> dict[str, Query]:
    builds = {
        "a01_executive_kpis": A.executive_kpis,
        "a02_monthly_coverage": lambda s: A.monthly_coverage(s, *COVERAGE_PERIOD),
        "a03_loss_summary": A.loss_summary,
        "a04_category_loss": A.category_losses,
        "a05_product_loss": A.worst_products,
        "a06_loss_pareto": A.loss_concentration,
        "a07_discount_margin": A.discount_margin,
        "a08_discount_loss_rate": A.discount_loss_rate,
        "a09_delivery_outcomes": A.delivery_outcomes,
        "a10_shipping_mode": A.shipping_mode_performance,
        "a11_delay_severity": A.delay_severity,
        "a12_customer_pareto": A.customer_concentration,
        "a13_value_vs_delivery": A.service_by_customer_value,
    }
    exact = {f"{name}_exact": _on_exact(star, lambda s, build=build: as_text(build(s))) for name, build in builds.items()}
    return {name: _on(star, build) for name, build in builds.items()} | exact


def _primitives() -> dict[str, Query]:
    def worst_items_first() -> list:
        return [F.col("order_profit_per_order").asc(), F.col("order_item_id").asc()]

    def margins(s: G.Star) -> DataFrame:
        totals = loss_split(s.fact, "product_key")
        return totals.select(
            "product_key",
            ratio_pct(F.col("net_profit"), F.col("total_sales")).alias("profit_margin_pct"),
        )

    def split_by_day(s: G.Star) -> DataFrame:
        return loss_split(s.fact, "order_date_key")

    def bands(s: G.Star) -> DataFrame:
        return s.fact.select(
            "order_item_id", discount_band(F.col("order_item_discount_rate")).alias("discount_band")
        )

    def rollup(s: G.Star) -> DataFrame:
        return order_rollup(s.fact, "order_profile_key")

    def sales_shares(s: G.Star) -> DataFrame:
        per_customer = s.fact.groupBy("customer_key").agg(F.sum("sales").alias("total_sales"))
        kept = Workspace(per_customer.sparkSession).materialize(per_customer, "summary")
        return share_of_total(kept, {"total_sales": "sales_share_pct"})

    def item_curve(s: G.Star) -> DataFrame:
        items = s.fact.select("order_item_id", "order_profit_per_order")
        return global_cumulative(items, "order_profit_per_order", worst_items_first(), "profit_rank")

    def item_buckets(s: G.Star) -> DataFrame:
        items = s.fact.select("order_item_id", "order_profit_per_order")
        return global_ntile(items, 7, worst_items_first(), "bucket").select("order_item_id", "bucket")

    def top_items(s: G.Star) -> DataFrame:
        biggest = [F.col("sales").desc(), F.col("order_item_id").asc()]
        return top_k_share(s.fact.select("sales", "order_item_id"), "sales", 100, biggest, "top_100_share_pct")

    def with_variance(s: G.Star) -> DataFrame:
        orders = order_rollup(s.fact, "order_profile_key")
        orders = lookup_join(orders, s.profile, ["order_profile_key"])
        return orders.withColumn("variance", schedule_variance())

    def variance_by_status(s: G.Star) -> DataFrame:
        parts = with_variance(s).groupBy("order_status").agg(
            F.count("*").alias("total_orders"),
            *mean_parts(F.col("variance"), "all"),
            *mean_parts(F.col("variance"), "kept", F.col("delivery_status") != A.CANCELED),
        )
        return parts.select(
            "order_status",
            "total_orders",
            mean(F.col("all_sum"), F.col("all_count")).alias("avg_variance_days"),
            mean(F.col("kept_sum"), F.col("kept_count")).alias("avg_kept_variance_days"),
        )

    def severity_by_type(s: G.Star) -> DataFrame:
        late = with_variance(s).where(F.col("delivery_status") == A.LATE)
        return late.groupBy("type").agg(*severity_counts(F.col("variance")))

    builds = {
        "p01_ratio_pct": margins,
        "p02_loss_split": split_by_day,
        "p03_discount_band": bands,
        "p04_order_rollup": rollup,
        "p05_share_of_total": sales_shares,
        "p06_global_cumulative": item_curve,
        "p07_global_ntile": item_buckets,
        "p08_topk_share": top_items,
        "p09_schedule_variance": variance_by_status,
        "p10_severity": severity_by_type,
    }
    return {name: _on(star, build) for name, build in builds.items()}


def _files() -> dict[str, Query]:
    def csv_import(spark: SparkSession, folder: str) -> DataFrame:
        """Raw rows written as a Windows-1252 export and imported again."""
        warehouse = _warehouse(spark, folder, "bronze")
        path = warehouse.workspace.fresh_path("export")
        write_export(warehouse.bronze, path)
        imported = read_export(spark, path)
        return imported.agg(
            F.count("*").alias("total_rows"),
            F.count_distinct("order_item_id").alias("distinct_order_items"),
            F.count_if(F.col("order_zipcode").isNull()).alias("null_order_zipcodes"),
            F.count_if(F.col("customer_zipcode") == "").alias("blank_zipcodes"),
            F.count_if(F.col("category_name").contains("É")).alias("accented_categories"),
            F.sum(F.char_length("category_name")).alias("category_characters"),
            F.count_if(P.has_outer_spaces(F.col("product_name"))).alias("padded_product_names"),
        )

    def multiline_import(spark: SparkSession, folder: str) -> DataFrame:
        """Raw rows with line breaks and quotes inside a field, exported and imported again."""
        warehouse = _warehouse(spark, folder, "bronze")
        path = warehouse.workspace.fresh_path("multiline")
        street = F.concat("customer_street", F.lit("\n"), "customer_city", F.lit('"\n'))
        write_export(warehouse.bronze.withColumn("customer_street", street), path)
        imported = read_export(spark, path, multiline=True)
        return imported.agg(
            F.count("*").alias("total_rows"),
            F.count_distinct("order_item_id").alias("distinct_order_items"),
            F.count_if(F.col("customer_street").contains("\n")).alias("streets_of_lines"),
            F.sum(F.char_length("customer_street")).alias("street_characters"),
            F.sum(F.char_length("category_name")).alias("category_characters"),
        )

    def pruned_scan(s: G.Star) -> DataFrame:
        """Two fact columns over one year of order dates."""
        year = s.fact.where(F.col("order_date_key").between(19980101, 19981231))
        return year.groupBy("order_date_key").agg(money(F.sum("sales")).alias("total_sales"))

    return {
        "io1_csv_import": csv_import,
        "io1_multiline_import": multiline_import,
        "io2_bronze_table": _on(bronze, lambda d: d),
        "io3_silver_table": _on(silver, lambda d: d),
        "io5_pruned_scan": _on(star, pruned_scan),
    }


def queries() -> dict[str, Query]:
    from cargolens.registry import defects

    return {
        **defects.queries(), **_profiles(), **_cleaning(), **_model(), **_analyses(), **_primitives(), **_files(),
    }
