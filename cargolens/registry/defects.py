"""Checks on tables with known defects, so that each has something to find.

The layers of the test data break no rule.  Here every raw row of some ids is repeated
or altered, and dimension rows of some keys are left out, before the same operators run;
all other rows stay.  The SQL names the defects directly and derives no dimension.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from cargolens import schemas as S
from cargolens.operators import profiling as P
from cargolens.plans import quality as Q, silver as C, star as G
from cargolens.registry import oracle, queries as Z

# Raw column, the order item ids that are altered (remainder 0), and the alteration.
ALTERED = {
    "customer_lname": (7, "concat(customer_lname, ' Jr')"),
    "customer_city": (17, "concat(customer_city, ' East')"),
    "product_category_id": (11, "'999'"),
    "department_name": (13, "concat(department_name, ' Two')"),
    "product_price": (19, "'0.01'"),
    "order_item_quantity": (23, "'many'"),
}
REPEATED = 50  # item ids that occur twice (remainder 0)
LOST_KEY, LOST_DAY = 3, 5  # last digit of dimension keys, day of the month
NO_CUSTOMER, LONG_MARKET = 60, 70  # item ids without a customer key, with a long market (remainder 0)


def defective(bronze: DataFrame) -> DataFrame:
    """All raw rows, some altered and some twice."""
    item = F.expr("cast(trim(order_item_id) as bigint)")
    altered = bronze.withColumns(
        {
            name: F.when(item % every == 0, F.expr(value)).otherwise(F.col(name))
            for name, (every, value) in ALTERED.items()
        }
    )
    return altered.unionByName(altered.where(item % REPEATED == 0))


def _incomplete(star: G.Star) -> G.Star:
    lost = lambda frame, key: frame.where(F.col(key) % 10 != LOST_KEY)
    return replace(
        star,
        customer=lost(star.customer, "customer_key"),
        product=lost(star.product, "product_key"),
        destination=lost(star.destination, "destination_key"),
        profile=lost(star.profile, "order_profile_key"),
        date=star.date.where(F.dayofmonth("full_date") != LOST_DAY),
    )


def _broken_fact(fact: DataFrame) -> DataFrame:
    """Some rows without a customer key, and some twice."""
    item = F.col("order_item_id")
    broken = fact.withColumn("customer_key", F.when(item % NO_CUSTOMER != 0, F.col("customer_key")))
    return broken.unionByName(broken.where(item % REPEATED == 0))


def _long_markets(silver: DataFrame) -> DataFrame:
    long = F.col("order_item_id") % LONG_MARKET == 0
    return silver.withColumn("market", F.when(long, F.repeat(F.lit("x"), 101)).otherwise(F.col("market")))


_VERSIONS = {
    "b21_fd_customer_name": ("customer_id", ["customer_fname", "customer_lname"], "name_versions"),
    "b22_fd_customer_location": (
        "customer_id", ["customer_city", "customer_state", "customer_country"], "location_versions",
    ),
    "b25_fd_product_category": ("product_card_id", ["product_category_id"], "category_versions"),
    "b27_fd_department_name": ("department_id", ["department_name"], "department_name_versions"),
}
_MISSING = ["customers", "products", "destinations", "order_profiles", "order_dates", "shipping_dates"]
_KEYS = dict(zip(_MISSING, ["customer_key", "product_key", "destination_key", "order_profile_key"]))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    raw = lambda build: Z._on(lambda spark, folder: defective(Z.bronze(spark, folder)), build)
    gold = lambda build: Z._with_silver_and_star(lambda d, s: build(d, _incomplete(s)))
    broken = lambda s: replace(s, fact=_broken_fact(s.fact))
    found = {
        "b03_found_duplicate_keys": raw(lambda d: P.duplicate_keys(d, "order_item_id")),
        "b21_found_product_versions": raw(
            lambda d: P.inconsistent_keys(d, "product_card_id", S.PRODUCT_ATTRIBUTES[1:])
        ),
        "b21_product_versions": Z._on(
            Z.bronze, lambda d: P.inconsistent_keys(d, "product_card_id", S.PRODUCT_ATTRIBUTES[1:])
        ),
        "s_found_quarantine": raw(
            lambda d: C.clean_or_quarantine(d)[1].select(
                "order_item_id", F.array_join("broken_columns", ",").alias("broken")
            )
        ),
        "s_found_accepted": raw(lambda d: P.row_count(C.clean_or_quarantine(d)[0])),
        "g_found_unloadable_customers": gold(
            lambda d, s: G.unloadable_keys(d, s.customer, G.CUSTOMER)
        ),
        "c10_found_missing_references": gold(lambda d, s: Q.missing_references(s)),
        "c17_found_violations": Z._with_silver_and_star(
            lambda d, s: Q.all_violations(_long_markets(d), broken(s))
        ),
        "c18_found_release_checks": gold(lambda d, s: Q.release_checks(d, broken(s))),
        "c02_found_missing_order_dates": gold(
            lambda d, s: Q.missing_dates(d, s, "order_timestamp", "missing_order_date")
        ),
        "c02b_found_missing_shipping_dates": gold(
            lambda d, s: Q.missing_dates(d, s, "shipping_timestamp", "missing_shipping_date")
        ),
    }
    for name, (key, dependents, label) in _VERSIONS.items():
        found[name.replace("_fd_", "_found_")] = raw(
            lambda d, key=key, dependents=dependents, label=label: P.functional_dependency(
                d, key, dependents, label
            )
        )
    for number, name in enumerate(_MISSING, start=10):
        found[f"c{number}_found_missing_{name}"] = gold(
            lambda d, s, name=name: Q.missing_reference(s, f"missing_{name}")
        )
    return found


def oracle_sql() -> dict[str, str]:
    item = "cast(trim(order_item_id) as bigint)"
    cases = ", ".join(
        f"case when {item} % {every} = 0 then {value} else {name} end as {name}"
        for name, (every, value) in ALTERED.items()
    )
    # Text joined by || is NULL if a part is, as in the alteration itself.
    cases = cases.replace("concat(customer_lname, ' Jr')", "customer_lname || ' Jr'")
    cases = cases.replace("concat(customer_city, ' East')", "customer_city || ' East'")
    cases = cases.replace("concat(department_name, ' Two')", "department_name || ' Two'")
    parts = (
        f"altered as (select * replace ({cases}) from raw)",
        f"defective as (select * from altered union all select * from altered where {item} % {REPEATED} = 0)",
    )
    raw = lambda select: oracle._with(
        select, oracle._LINES, oracle._JOINED, oracle._ITEMS, oracle._RAW, *parts
    )

    def versions(source: str) -> str:
        return " union all ".join(
            f"select '{c}' as column_name, count(*) filter (where v > 1) as varying_keys from "
            f"(select count(distinct coalesce({c}, '~null~')) as v from {source} group by product_card_id)"
            for c in S.PRODUCT_ATTRIBUTES[1:]
        )

    found = {
        "b03_found_duplicate_keys": raw(
            "select order_item_id, count(*) as duplicate_count from defective group by 1 having count(*) > 1"
        ),
        "b21_found_product_versions": raw(versions("defective")),
        "b21_product_versions": raw(versions("raw")),
        "s_found_quarantine": raw(
            "select order_item_id, 'order_item_quantity' as broken from defective "
            "where order_item_quantity = 'many'"
        ),
        "s_found_accepted": raw("select count(*) as total_rows from defective where order_item_quantity <> 'many'"),
        "g_found_unloadable_customers": oracle._on_keyed(
            f"select customer_id, count(*) as row_count from keyed where customer_key % 10 = {LOST_KEY} group by 1"
        ),
    }
    for name, (key, dependents, label) in _VERSIONS.items():
        # NULL parts are skipped when several columns are joined.
        version = dependents[0] if len(dependents) == 1 else f"concat({', {0}, '.format(repr('|')).join(dependents)})"
        found[name.replace("_fd_", "_found_")] = raw(
            f"select {key}, count(distinct {version}) as {label} from defective group by 1 "
            f"having count(distinct {version}) > 1"
        )
    for name, key in _KEYS.items():
        found[f"c{10 + _MISSING.index(name)}_found_missing_{name}"] = oracle._on_keyed(
            f"select count(*) filter (where {key} % 10 = {LOST_KEY}) as missing_{name} from keyed"
        )
    broken = (
        f"broken_once as (select * replace (case when order_item_id % {NO_CUSTOMER} <> 0 then customer_key end "
        "as customer_key) from keyed), broken as (select * from broken_once union all "
        f"select * from broken_once where order_item_id % {REPEATED} = 0)"
    )
    long = (
        f"long_markets as (select * replace (case when order_item_id % {LONG_MARKET} = 0 then repeat('x', 101) "
        "else market end as market) from typed)"
    )
    sources = {"fact_order_item": ("from keyed", "from broken"), "silver": ("from typed", "from long_markets")}
    found["c17_found_violations"] = oracle._on_keyed(
        " union all ".join(
            f"select '{table}' as table_name, '{constraint}' as constraint_name, '{column}' as column_name, "
            f"({sql.replace(*sources.get(table, ('', '')))}) as violations"
            for table, constraint, column, sql in oracle._constraints()
        ), broken, long, oracle._CALENDAR,
    )
    lost = {f"missing_{name}": f"{key} is null or {key} % 10 = {LOST_KEY}" for name, key in _KEYS.items()}
    lost |= {f"missing_{role}_dates": f"day({role}_timestamp) = {LOST_DAY}" for role in ("order", "shipping")}
    found["c10_found_missing_references"] = oracle._on_keyed(
        "select " + ", ".join(f"count(*) filter (where {test}) as {name}" for name, test in lost.items()) + " from keyed"
    )
    tests = [
        ("fact_rows", "(select count(*) from typed)", "(select count(*) from broken)"),
        ("distinct_order_items", "(select count(*) from broken)", "(select count(distinct order_item_id) from broken)"),
        *[(name, "0", f"(select count(*) from broken where {test})") for name, test in lost.items()],
        *[
            (f"uncovered_{role}_timestamp", "0",
             f"(select count(distinct cast({role}_timestamp as date)) from typed where day({role}_timestamp) = {LOST_DAY})")
            for role in ("order", "shipping")
        ],
    ]
    found["c18_found_release_checks"] = oracle._on_keyed(
        " union all ".join(
            f"select '{name}' as check_name, cast({expected} as bigint) as expected, cast({actual} as bigint) as actual, "
            f"{expected} = {actual} as passed"
            for name, expected, actual in tests
        ), broken,
    )
    for number, role, suffix in ((14, "order", ""), (15, "shipping", "b")):
        lost = f"day({role}_timestamp) = {LOST_DAY}"
        found[f"c{number}_found_missing_{role}_dates"] = oracle._on_keyed(
            f"select count(*) filter (where {lost}) as missing_{role}_dates from keyed"
        )
        found[f"c02{suffix}_found_missing_{role}_dates"] = oracle._on_typed(
            f"select distinct cast({role}_timestamp as date) as missing_{role}_date from typed where {lost}"
        )
    return found
