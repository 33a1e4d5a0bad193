"""Release conditions of the warehouse, as result rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cargolens import schemas as S
from cargolens.operators import checks
from cargolens.operators.joins import unmatched_keys
from cargolens.operators.profiling import key_grain, row_count
from cargolens.operators.references import Reference, missing_references as count_missing
from cargolens.plans.silver import RULES
from cargolens.plans.star import DIMENSIONS, Dimension, Star

# Fact keys, the dimension column each refers to, and the name of its check.
_REFERENCES = [
    ("missing_customers", "customer", "customer_key", "customer_key"),
    ("missing_products", "product", "product_key", "product_key"),
    ("missing_destinations", "destination", "destination_key", "destination_key"),
    ("missing_order_profiles", "profile", "order_profile_key", "order_profile_key"),
    ("missing_order_dates", "date", "order_date_key", "date_key"),
    ("missing_shipping_dates", "date", "shipping_date_key", "date_key"),
]


def calendar_coverage(star: Star) -> DataFrame:
    return star.date.agg(
        F.min("full_date").alias("min_dim_date"),
        F.max("full_date").alias("max_dim_date"),
        F.count("*").alias("total_dates"),
    )


def missing_dates(silver: DataFrame, star: Star, moment: str, name: str) -> DataFrame:
    """Days of a timestamp column that the calendar lacks."""
    days = silver.select(F.to_date(moment).alias(name))
    return unmatched_keys(days, star.date, [(name, "full_date")]).select(name)


def reconciliation(silver: DataFrame, star: Star) -> DataFrame:
    """Cleaned rows beside fact rows."""
    loaded = row_count(star.fact, "fact_rows")
    return row_count(silver, "silver_rows").select(
        "silver_rows", loaded.scalar().alias("fact_rows")
    )


def fact_grain(star: Star) -> DataFrame:
    return key_grain(star.fact, "order_item_id", "distinct_order_items", total="total_rows")


def dimension_counts(star: Star) -> dict[str, DataFrame]:
    return {
        "customers": row_count(star.customer, "customers"),
        "products": row_count(star.product, "products"),
        "destinations": row_count(star.destination, "destinations"),
        "order_profiles": row_count(star.profile, "order_profiles"),
        "dates": row_count(star.date, "dates"),
    }


def references(star: Star) -> dict[str, Reference]:
    """What each fact key refers to, by the name of its check."""
    return {
        name: Reference(key, getattr(star, table), column) for name, table, key, column in _REFERENCES
    }


def missing_references(star: Star) -> DataFrame:
    """One row: fact rows without a dimension row, for every fact key in one scan."""
    return count_missing(star.fact, references(star))


def missing_reference(star: Star, name: str) -> DataFrame:
    return count_missing(star.fact, {name: references(star)[name]})


def silver_violations(silver: DataFrame) -> DataFrame:
    limits = {rule.target: rule.max_length for rule in RULES if rule.max_length}
    return checks.union_all([
        checks.check_unique(silver, "order_item_id"),
        checks.check_not_null(silver, "order_item_id"),
        checks.check_max_length(silver, limits),
    ])


def dimension_violations(dimension: DataFrame, spec: Dimension) -> DataFrame:
    found = [checks.check_unique(dimension, spec.key)]
    if spec.unique:
        found.append(checks.check_unique(dimension, *spec.natural_key))
        found.append(checks.check_not_null(dimension, *spec.natural_key))
    return checks.union_all(found)


def calendar_violations(date: DataFrame) -> DataFrame:
    return checks.union_all([
        checks.check_unique(date, "date_key"), checks.check_unique(date, "full_date")
    ])


def fact_nulls(fact: DataFrame) -> DataFrame:
    return checks.check_not_null(fact, *S.FACT_NOT_NULL)


def fact_violations(fact: DataFrame) -> DataFrame:
    return checks.union_all([checks.check_unique(fact, "order_item_id"), fact_nulls(fact)])


def _labelled(tables: list[tuple[str, DataFrame]]) -> DataFrame:
    return checks.union_all([
        found.select(F.lit(table).alias("table_name"), "*") for table, found in tables
    ])


def model_violations(dimensions: list[tuple[Dimension, DataFrame]], date: DataFrame) -> DataFrame:
    """Constraints of all dimensions and the calendar, checked in one job."""
    tables = [(spec.table, dimension_violations(frame, spec)) for spec, frame in dimensions]
    return _labelled([*tables, ("dim_date", calendar_violations(date))])


def all_violations(silver: DataFrame, star: Star) -> DataFrame:
    """Every declared constraint with its number of violations."""
    dimensions = [(spec, star.dimension(spec)) for spec in DIMENSIONS]
    return checks.union_all([
        _labelled([("silver", silver_violations(silver))]),
        model_violations(dimensions, star.date),
        _labelled([("fact_order_item", fact_violations(star.fact))]),
    ])


def uncovered_days(silver: DataFrame, star: Star) -> DataFrame:
    """One row: for each timestamp column, how many of its days the calendar lacks.

    Days are counted per column in one scan, before they meet the calendar.
    """
    moments = ["order_timestamp", "shipping_timestamp"]
    days = silver.select(
        F.inline(F.array(*[F.struct(F.lit(m).alias("moment"), F.to_date(m).alias("day")) for m in moments]))
    )
    lost = days.distinct().join(star.date.select(F.col("full_date").alias("day")), "day", "left_anti")
    return lost.agg(*[F.count_if(F.col("moment") == m).alias(f"uncovered_{m}") for m in moments])


def release_checks(silver: DataFrame, star: Star) -> DataFrame:
    """(check_name, expected, actual, passed) for every release condition.

    The fact is read twice: once for its rows and all its references, once for its grain.
    """
    zero = F.lit(0)
    facts = count_missing(star.fact, references(star), F.count("*").alias("fact_rows"))
    loaded = row_count(silver, "silver_rows").scalar()
    return checks.union_all([
        checks.expectations(
            facts,
            {"fact_rows": (loaded, F.col("fact_rows"))}
            | {name: (zero, F.col(name)) for name in references(star)},
        ),
        checks.expectations(
            fact_grain(star), {"distinct_order_items": (F.col("total_rows"), F.col("distinct_order_items"))}
        ),
        checks.expectations(
            found := uncovered_days(silver, star), {name: (zero, F.col(name)) for name in found.columns}
        ),
    ])


def order_consistency(silver: DataFrame) -> DataFrame:
    """Orders whose items disagree on an attribute that delivery rates rely on."""
    from cargolens.operators.profiling import inconsistent_keys

    return inconsistent_keys(silver, "order_id", ["delivery_status", "shipping_mode", "customer_id"])
