"""SQL that computes each query's result independently, on the same tables.

The shared expressions only shape the input (which order item has which
values); profiling, cleaning, modelling and analysis are written out here in
plain SQL over common table expressions, with ordinary window functions.
Ratios are rounded half away from zero with whole-number arithmetic.
"""

from __future__ import annotations

from cargolens import schemas as S
from cargolens.plans import silver as C
from cargolens.plans.order_items import ITEM_COLUMNS, LINE_COLUMNS, RAW_TEXT
from cargolens.registry.queries import CLEANING_SUBSETS, COUNTED, RANGE_COLUMNS, RANGES, SKETCHED_COLUMNS


def _list(columns: dict[str, str]) -> str:
    return ",\n  ".join(f"{expression} as {name}" for name, expression in columns.items())


def _half_up(numerator: str, denominator: str, digits: int, output: str = "double") -> str:
    """numerator / denominator, both whole numbers, rounded half away from zero."""
    n, d = f"cast({numerator} as hugeint)", f"cast({denominator} as hugeint)"
    scaled = f"(abs({n}) * {2 * 10 ** digits} + abs({d})) // (2 * abs({d}))"
    value = f"cast(sign({n}) * sign({d}) * ({scaled}) as {output}) / {10 ** digits}"
    return f"case when {d} = 0 then null else {value} end"


def _cents(money: str) -> str:
    return f"(({money}) * 100)"


def _pct(part: str, whole: str) -> str:
    return _half_up(f"({part}) * 100", whole, 2)


def _money_pct(part: str, whole: str) -> str:
    return _half_up(f"{_cents(part)} * 100", _cents(whole), 2)


def _avg(value: str, condition: str | None = None) -> str:
    kept = f" filter (where {condition})" if condition else ""
    return _half_up(f"sum({value}){kept}", f"count({value}){kept}", 2)


def _dbl(value: str) -> str:
    return f"cast({value} as double)"


def _big(value: str) -> str:
    return f"cast({value} as bigint)"


_LINES = f"""lines as (
select {_list(LINE_COLUMNS)} from lineitem
), numbered as (
select *, row_number() over (order by {", ".join(f"{c} nulls last" for c in LINE_COLUMNS)}) as order_item_id
from lines
)"""

_JOINED = """joined as (
select n.*, o.*, c.*, p.*, s.*, cn.n_name as customer_nation, sn.n_name as supplier_nation,
  r.r_name as supplier_region
from numbered n
join orders o on n.l_orderkey = o.o_orderkey
join customer c on o.o_custkey = c.c_custkey
join part p on n.l_partkey = p.p_partkey
join supplier s on n.l_suppkey = s.s_suppkey
join nation cn on c.c_nationkey = cn.n_nationkey
join nation sn on s.s_nationkey = sn.n_nationkey
join region r on sn.n_regionkey = r.r_regionkey
)"""

_PROFIT = ITEM_COLUMNS["order_profit_per_order"]
_ITEMS = f"""items as (
select {_list(ITEM_COLUMNS)},
  cast({_half_up(f"({_PROFIT}) * 100", "sales * 100", 4)} as decimal(8,4)) as order_item_profit_ratio,
  o_orderdate + to_minutes(o_orderkey % 1440) as order_timestamp,
  l_shipdate + to_minutes(l_partkey % 1440) as shipping_timestamp
from joined
)"""


def _spelled(moment: str) -> str:
    return (
        f"case when order_id % 2 = 0 then strftime({moment}, '%-m/%-d/%Y %-H:%M') "
        f"else strftime({moment}, '%m/%d/%Y %H:%M') end"
    )


_SPELLING = {name: RAW_TEXT.get(name, f"cast({name} as string)") for name in S.BRONZE_COLUMNS}
_SPELLING["order_date"] = _spelled("order_timestamp")
_SPELLING["shipping_date"] = _spelled("shipping_timestamp")
_RAW = f"raw as (\nselect {_list(_SPELLING)} from items\n)"


def _title(text: str) -> str:
    runs = f"regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+')"
    return (
        f"coalesce(list_aggregate(list_transform({runs}, lambda w: upper(w[1]) || w[2:]), "
        f"'string_agg', ''), case when {text} = '' then '' end)"
    )


_SQL_TYPES = {
    S.ID: "bigint", S.INT: "integer", S.SHORT: "smallint", S.MONEY: "decimal(12,2)",
    S.RATE: "decimal(8,4)", S.COORDINATE: "decimal(10,6)",
}


def _cleaned(rule: C.Rule) -> str:
    raw = rule.source or rule.target
    if rule.kind == C.TITLE:
        return _title(f"trim({raw}, ' ')")
    if rule.kind == C.STATUS:
        return _title(f"replace(trim({raw}, ' '), '_', ' ')")
    if rule.kind == C.UPPER:
        return f"upper(trim({raw}, ' '))"
    if rule.kind == C.KEEP:
        return f"trim({raw}, ' ')"
    blank = f"nullif(trim({raw}, ' '), '')"
    if rule.kind == C.BLANK_NULL:
        return blank
    if rule.kind == C.MOMENT:
        return f"strptime({blank}, '%m/%d/%Y %H:%M')"
    # Fractions are read exactly before they are rounded to the target scale.
    exact = f"cast({blank} as decimal(28,10))"
    whole = rule.data_type in (S.ID, S.INT, S.SHORT)
    return f"cast({blank if whole else exact} as {_SQL_TYPES[rule.data_type]})"


_SILVER = "silver as (\nselect {} from raw\n)".format(
    _list({rule.target: _cleaned(rule) for rule in C.RULES})
)


def _key(columns: list[str]) -> str:
    order = ", ".join(f"{c} nulls last" for c in columns)
    return f"dense_rank() over (order by {order})"


# Modelling and analysis read the typed items directly: the whole way through
# raw text and cleaning must lead back to exactly these values.
_TYPED_NAMES = {
    "latitude": "cast(exact_latitude as decimal(10,6))",
    "longitude": "cast(exact_longitude as decimal(10,6))",
    "order_item_discount": "cast(exact_discount as decimal(12,2))",
}
_TYPED = "typed as (\nselect {} from items\n)".format(
    _list({rule.target: _TYPED_NAMES.get(rule.target, rule.target) for rule in C.RULES})
)
_KEYED = f"""keyed as (
select *,
  {_key(["customer_id"])} as customer_key,
  {_key(["product_card_id"])} as product_key,
  {_key(S.DESTINATION_ATTRIBUTES)} as destination_key,
  {_key(S.PROFILE_ATTRIBUTES)} as order_profile_key,
  cast(strftime(order_timestamp, '%Y%m%d') as integer) as order_date_key,
  cast(strftime(shipping_timestamp, '%Y%m%d') as integer) as shipping_date_key
from typed
)"""
_CALENDAR = """bounds as (
select least(min(cast(order_timestamp as date)), min(cast(shipping_timestamp as date))) as first_day,
  greatest(max(cast(order_timestamp as date)), max(cast(shipping_timestamp as date))) as last_day
from typed
), calendar as (
select cast(strftime(d, '%Y%m%d') as integer) as date_key, cast(d as date) as full_date,
  cast(year(d) as integer) as year, cast(quarter(d) as integer) as quarter,
  cast(month(d) as integer) as month, monthname(d) as month_name,
  cast(week(d) as integer) as week_of_year, cast(day(d) as integer) as day, dayname(d) as day_name,
  isodow(d) in (6, 7) as is_weekend
from (select unnest(generate_series(first_day, last_day, interval 1 day)) as d from bounds)
)"""
_ORDERS = """order_level as (
select order_id, delivery_status, shipping_mode, sum(sales) as order_sales,
  max(days_for_shipping_real) - max(days_for_shipment_scheduled) as variance,
  max(days_for_shipping_real) as actual, max(days_for_shipment_scheduled) as scheduled
from typed group by order_id, delivery_status, shipping_mode
)"""
_LOSSES = """losses as (
select product_name, sum(case when order_profit_per_order < 0 then order_profit_per_order else 0 end) as lost
from typed group by product_name having lost < 0
), ranked_losses as (
select *, row_number() over (order by lost, product_name) as loss_rank,
  sum(abs(lost)) over () as all_lost,
  sum(abs(lost)) over (order by lost, product_name rows unbounded preceding) as lost_so_far
from losses
)"""


def _with(select: str, *parts: str) -> str:
    return "with " + ",\n".join(parts) + "\n" + select


def _on_raw(select: str) -> str:
    return _with(select, _LINES, _JOINED, _ITEMS, _RAW)


def _on_silver(select: str) -> str:
    return _with(select, _LINES, _JOINED, _ITEMS, _RAW, _SILVER)


def _on_typed(select: str, *parts: str) -> str:
    return _with(select, _LINES, _JOINED, _ITEMS, _TYPED, *parts)


def _on_keyed(select: str, *parts: str) -> str:
    return _on_typed(select, _KEYED, *parts)


def _columns(names: list[str], decimals: set[str]) -> str:
    return ", ".join(f"{_dbl(n)} as {n}" if n in decimals else n for n in names)


_DECIMALS = {rule.target for rule in C.RULES if rule.data_type in (S.MONEY, S.RATE, S.COORDINATE)}


def _frequency(column: str) -> str:
    return _on_raw(f"select {column}, count(*) as row_count from raw group by {column}")


def _versions(key: str, version: str, name: str) -> str:
    return _on_raw(
        f"select {key}, count(distinct {version}) as {name} from raw group by {key} "
        f"having count(distinct {version}) > 1"
    )


def _micro_mean(column: str) -> str:
    whole = f"cast(cast({column} as decimal(18,6)) * 1000000 as hugeint)"
    return f"{_half_up(f'sum({whole})', f'count({column})', 0)} / 1000000"


def _range(column: str, label: str, mean: bool = True) -> str:
    value = f"cast({column} as decimal(18,6))"
    average = f", {_micro_mean(column)} as avg_{label}" if mean else ""
    return _on_raw(
        f"select {_dbl(f'min({value})')} as min_{label}, {_dbl(f'max({value})')} as max_{label}{average} from raw"
    )


def _shortest(value: str) -> str:
    """A decimal as text without zeros at its end."""
    return f"regexp_replace(cast({value} as varchar), '\\.?0+$', '')"


def _exact_range(column: str) -> str:
    value = f"cast({column} as decimal(18,6))"
    micros = _half_up(f"sum(cast({value} * 1000000 as hugeint))", f"count({column})", 0, "decimal(30,0)")
    mean = f"({micros.replace(' / 1 end', ' end')}) * cast(0.000001 as decimal(7,6))"
    return (
        f"select '{column}' as column_name, {_shortest(f'min({value})')} as lowest, "
        f"{_shortest(f'max({value})')} as highest, cast({mean} as varchar) as mean from raw"
    )


def _null_profile(column: str) -> str:
    missing = f"(count(*) - count({column}))"
    return (
        f"count(*) as total_rows, count({column}) as non_null_rows, {missing} as null_rows, "
        f"{_pct(missing, 'count(*)')} as null_percentage"
    )


def _profiles() -> dict[str, str]:
    def count(condition: str, name: str) -> str:
        return _on_raw(f"select count(*) as {name} from raw where {condition}")

    def number(column: str) -> str:
        return f"cast({column} as decimal(18,6))"

    def moments(column: str, label: str) -> str:
        parsed = f"strptime(nullif(trim({column}), ''), '%m/%d/%Y %H:%M')"
        return _on_raw(
            f"select min({parsed}) as earliest_{label}_date_raw, max({parsed}) as latest_{label}_date_raw from raw"
        )

    found = {
        "b01_row_count": _on_raw("select count(*) as total_rows from raw"),
        "b02_grain": _on_raw(
            "select count(*) as total_rows, count(distinct order_item_id) as distinct_order_items from raw"
        ),
        "b03_duplicate_keys": _on_raw(
            "select order_item_id, count(*) as duplicate_count from raw group by order_item_id having count(*) > 1"
        ),
        "b04_distinct_orders": _on_raw("select count(distinct order_id) as distinct_orders from raw"),
        "b05_customer_id_mismatch": count("customer_id <> order_customer_id", "mismatched_customer_ids"),
        "b06_product_id_mismatch": count("product_card_id <> order_item_cardprod_id", "mismatched_product_ids"),
        "b07_null_order_zipcode": _on_raw(f"select {_null_profile('order_zipcode')} from raw"),
        "b08_null_description": _on_raw(
            "select count(*) as total_rows, count(product_description) as non_null_rows from raw"
        ),
        "b09_product_status": _frequency("product_status"),
        "b10_email_sample": _on_raw("select distinct customer_email from raw order by 1 nulls last limit 20"),
        "b11_password_rows": _on_raw("select count(customer_password) as populated_password_rows from raw"),
        "b12_image_sample": _on_raw("select distinct product_image from raw order by 1 nulls last limit 20"),
        "b20_distinct_customers": _on_raw("select count(distinct customer_id) as distinct_customers from raw"),
        "b21_fd_customer_name": _versions(
            "customer_id", "concat(customer_fname, '|', customer_lname)", "name_versions"
        ),
        "b22_fd_customer_location": _versions(
            "customer_id", "concat(customer_city, '|', customer_state, '|', customer_country)",
            "location_versions",
        ),
        "b23_distinct_products": _on_raw("select count(distinct product_card_id) as distinct_products from raw"),
        "b24_fd_product_name": _versions("product_card_id", "product_name", "product_name_versions"),
        "b25_fd_product_category": _versions("product_card_id", "product_category_id", "category_versions"),
        "b26_fd_category_name": _versions("category_id", "category_name", "category_name_versions"),
        "b27_fd_department_name": _versions("department_id", "department_name", "department_name_versions"),
        "b35_range_discount_rate": _range("order_item_discount_rate", "discount_rate", mean=False),
        "b36_range_profit_ratio": _range("order_item_profit_ratio", "profit_ratio", mean=False),
        "b37_negative_profit": count(f"{number('order_profit_per_order')} < 0", "negative_profit_rows"),
        "b38_zero_quantity": count(f"{number('order_item_quantity')} = 0", "zero_quantity_rows"),
        "b39_negative_quantity": count(f"{number('order_item_quantity')} < 0", "negative_quantity_rows"),
        "b40_negative_sales": count(f"{number('sales')} < 0", "negative_sales_rows"),
        "b41_money_sample": _on_raw(
            "select sales, sales_per_customer, order_item_total, benefit_per_order, order_profit_per_order "
            "from raw order by cast(order_item_id as bigint) limit 50"
        ),
        "b42_sales_vs_total": count(
            f"round({number('sales')}, 2) <> round({number('order_item_total')}, 2)", "different_rows"
        ),
        "b43_benefit_vs_profit": count(
            f"round({number('benefit_per_order')}, 2) <> round({number('order_profit_per_order')}, 2)",
            "different_rows",
        ),
        "b44_date_sample": _on_raw(
            "select order_date, shipping_date from raw order by cast(order_item_id as bigint) limit 20"
        ),
        "b45_order_dates": moments("order_date", "order"),
        "b46_shipping_dates": moments("shipping_date", "shipping"),
        "b07_null_profile_all": _on_raw(
            " union all ".join(
                f"select '{c}' as column_name, {_null_profile(c)} from raw" for c in S.BRONZE_COLUMNS
            )
        ),
        "b09_constant_columns": _on_raw(
            " union all ".join(
                f"select '{c}' as column_name, min({c}) as lowest_value, max({c}) as highest_value, "
                f"count(distinct {c}) <= 1 as is_constant from raw"
                for c in S.BRONZE_COLUMNS
            )
        ),
        "b28_numeric_profile_all": _on_raw(
            " union all ".join(
                f"select '{c}' as column_name, {_dbl(f'min({number(c)})')} as lowest, "
                f"{_dbl(f'max({number(c)})')} as highest, {_micro_mean(c)} as mean from raw"
                for c in RANGE_COLUMNS
            )
        ),
        "b28_exact_ranges": _on_raw(" union all ".join(map(_exact_range, RANGE_COLUMNS))),
        "b02_sketched_counts": _on_raw(
            " union all ".join(
                f"select '{c}' as column_name, count(distinct {c}) as exact_values, true as is_close from raw"
                for c in SKETCHED_COLUMNS
            )
        ),
        "b21_attribute_versions": _on_raw(
            " union all ".join(
                f"select '{c}' as column_name, count(*) filter (where v > 1) as varying_keys from "
                f"(select count(distinct coalesce({c}, '~null~')) as v from raw group by order_customer_id)"
                for c in S.CUSTOMER_ATTRIBUTES[1:]
            )
        ),
    }
    frequencies = {
        "b13_freq_delivery_status": "delivery_status", "b14_freq_late_risk": "late_delivery_risk",
        "b15_freq_segment": "customer_segment", "b16_freq_market": "market",
        "b17_freq_order_status": "order_status", "b18_freq_shipping_mode": "shipping_mode",
        "b19_freq_type": "type",
    }
    found.update({name: _frequency(column) for name, column in frequencies.items()})
    found.update({name: _range(column, label) for name, (column, label) in RANGES.items()})
    spaces = {
        "b47_ws_product_name": ("product_name", "product_names_with_spaces"),
        "b48_ws_first_name": ("customer_fname", "customer_first_names_with_spaces"),
        "b49_ws_last_name": ("customer_lname", "customer_last_names_with_spaces"),
        "b50_ws_order_status": ("order_status", "order_status_with_spaces"),
    }
    found.update({q: count(f"{column} <> trim({column}, ' ')", name) for q, (column, name) in spaces.items()})
    return found


def _cleaning() -> dict[str, str]:
    names = [rule.target for rule in C.RULES]
    found = {
        name: _on_silver(
            "select " + _columns(
                ["order_item_id", *[r.target for r in rules if r.target != "order_item_id"]], _DECIMALS
            ) + " from silver"
        )
        for name, rules in CLEANING_SUBSETS.items()
    }
    found["s_clean"] = _on_silver(f"select {_columns(names, _DECIMALS)} from silver")
    found["s12_excluded_columns"] = _on_typed(
        " union all ".join(
            f"select count(*) as rows, '{c}' as column_name, false as is_written from typed"
            for c in S.EXCLUDED_COLUMNS
        )
    )
    kinds = {rule.target: rule.data_type.simpleString() for rule in C.RULES}
    found["io6_written_columns"] = _on_typed(
        " union all ".join(
            f"select '{n}' as column_name, '{i} {kinds[n]}' as place, count({n}) as non_null_rows from typed"
            for i, n in enumerate(names, start=1)
        )
    )
    exact = [n for n in names if kinds[n].startswith("decimal")]
    found["s_exact_decimals"] = _on_typed(
        "select order_item_id, "
        + ", ".join(f"cast(cast({n} as {kinds[n]}) as varchar) as {n}" for n in exact) + " from typed"
    )
    found["s12_excluded_in_bronze"] = _on_raw(
        " union all ".join(
            f"select '{c}' as column_name, {_null_profile(c)} from raw" for c in S.EXCLUDED_COLUMNS
        )
    )
    found["s13_row_preservation"] = _on_silver(
        "select (select count(*) from raw) as bronze_rows, (select count(*) from silver) as silver_rows"
    )
    found["io2_bronze_table"] = _on_raw(f"select {', '.join(S.BRONZE_COLUMNS)} from raw")
    found["io3_silver_table"] = _on_typed(f"select {_columns(names, _DECIMALS)} from typed")
    found["io1_csv_import"] = _on_raw(
        "select count(*) as total_rows, count(distinct order_item_id) as distinct_order_items, "
        "count(*) filter (where order_zipcode is null) as null_order_zipcodes, "
        "count(*) filter (where customer_zipcode = '') as blank_zipcodes, "
        "count(*) filter (where contains(category_name, 'É')) as accented_categories, "
        f"{_big('sum(length(category_name))')} as category_characters, "
        "count(*) filter (where product_name <> trim(product_name, ' ')) as padded_product_names from raw"
    )
    street = """customer_street || chr(10) || customer_city || '"' || chr(10)"""
    found["io1_multiline_import"] = _on_raw(
        "select count(*) as total_rows, count(distinct order_item_id) as distinct_order_items, "
        f"count({street}) as streets_of_lines, {_big(f'sum(length({street}))')} as street_characters, "
        f"{_big('sum(length(category_name))')} as category_characters from raw"
    )
    return found


_DIMENSIONS = {
    "dim_customer": ("customer_key", S.CUSTOMER_ATTRIBUTES, ["customer_id"]),
    "dim_product": ("product_key", S.PRODUCT_ATTRIBUTES, ["product_card_id"]),
    "dim_destination": ("destination_key", S.DESTINATION_ATTRIBUTES, S.DESTINATION_ATTRIBUTES),
    "dim_order_profile": ("order_profile_key", S.PROFILE_ATTRIBUTES, S.PROFILE_ATTRIBUTES),
}


def _constraints() -> list[tuple[str, str, str, str]]:
    """(table, constraint, column, SQL that counts violations)."""

    def duplicates(columns: str, source: str) -> str:
        first = columns.split(",")[0]
        return (
            f"select count(*) from (select 1 from ({source}) where {first} is not null "
            f"group by {columns} having count(*) > 1)"
        )

    def nulls(column: str, source: str) -> str:
        return f"select count(*) from ({source}) where {column} is null"

    rows = [
        ("silver", "unique", "order_item_id", duplicates("order_item_id", "select * from typed")),
        ("silver", "not_null", "order_item_id", nulls("order_item_id", "select * from typed")),
    ]
    for rule in C.RULES:
        if rule.max_length:
            too_long = f"select count(*) from typed where length({rule.target}) > {rule.max_length}"
            rows.append(("silver", "max_length", rule.target, too_long))
    for table, (key, attributes, natural) in _DIMENSIONS.items():
        source = f"select distinct {key}, {', '.join(attributes)} from keyed"
        rows.append((table, "unique", key, duplicates(key, source)))
        if len(natural) == 1:
            rows.append((table, "unique", natural[0], duplicates(natural[0], source)))
            rows.append((table, "not_null", natural[0], nulls(natural[0], source)))
    for column in ("date_key", "full_date"):
        rows.append(("dim_date", "unique", column, duplicates(column, "select * from calendar")))
    rows.append(
        ("fact_order_item", "unique", "order_item_id", duplicates("order_item_id", "select * from keyed"))
    )
    for column in S.FACT_NOT_NULL:
        rows.append(("fact_order_item", "not_null", column, nulls(column, "select * from keyed")))
    return rows


def _model() -> dict[str, str]:
    found = {}
    for query, (table, (key, attributes, _)) in zip(
        ["g01_dim_customer", "g02_dim_product", "g03_dim_destination", "g04_dim_order_profile"],
        _DIMENSIONS.items(),
    ):
        found[query] = _on_keyed(f"select distinct {key}, {_columns(attributes, _DECIMALS)} from keyed")
    for query, (key, _, natural) in zip(
        ["g09_customer_lookup", "g10_product_lookup", "g11_destination_lookup", "g12_profile_lookup"],
        _DIMENSIONS.values(),
    ):
        found[query] = _on_keyed(f"select order_item_id, {key}, {', '.join(natural)} from keyed")
    found["g05_date_bounds"] = _on_typed(
        "select first_day as min_date, last_day as max_date from bounds", _CALENDAR
    )
    found["g06_dim_date"] = _on_typed("select * from calendar", _CALENDAR)
    found["g07_dense_key"] = _on_keyed(
        " union all ".join(
            f"select '{table}' as table_name, min({key}) as lowest_key, max({key}) as highest_key, "
            f"count(distinct {key}) as total_rows, count(distinct {key}) as distinct_keys from keyed"
            for table, (key, _, _) in _DIMENSIONS.items()
        )
    )
    found["g08_fact"] = _on_keyed(f"select {_columns(S.FACT_COLUMNS, _DECIMALS)} from keyed")
    found["g13_date_key"] = _on_keyed("select order_item_id, order_date_key, shipping_date_key from keyed")
    found["c01_calendar_coverage"] = _on_typed(
        "select min(full_date) as min_dim_date, max(full_date) as max_dim_date, count(*) as total_dates "
        "from calendar", _CALENDAR,
    )
    for query, moment, name in (
        ("c02_missing_order_dates", "order_timestamp", "missing_order_date"),
        ("c02b_missing_shipping_dates", "shipping_timestamp", "missing_shipping_date"),
    ):
        found[query] = _on_typed(
            f"select distinct cast(t.{moment} as date) as {name} from typed t "
            f"left join calendar d on cast(t.{moment} as date) = d.full_date where d.date_key is null",
            _CALENDAR,
        )
    found["c03_reconciliation"] = _on_keyed(
        "select (select count(*) from typed) as silver_rows, (select count(*) from keyed) as fact_rows"
    )
    found["c04_fact_grain"] = _on_keyed(
        "select count(*) as total_rows, count(distinct order_item_id) as distinct_order_items from keyed"
    )
    keys = [key for key, _, _ in _DIMENSIONS.values()]
    for number, (name, key) in enumerate(zip(COUNTED, keys), start=5):
        found[f"c{number:02d}_{name}"] = _on_keyed(f"select count(distinct {key}) as {name} from keyed")
    found["c09_dates"] = _on_typed("select count(*) as dates from calendar", _CALENDAR)
    for number, (name, (key, attributes, _)) in enumerate(
        zip(["customers", "products", "destinations", "order_profiles"], _DIMENSIONS.values()), start=10
    ):
        found[f"c{number:02d}_missing_{name}"] = _on_keyed(
            f"select count(*) as missing_{name} from keyed f left join (select distinct {key}, "
            f"{attributes[0]} from keyed) d on f.{key} = d.{key} where d.{key} is null"
        )
    for number, role in ((14, "order"), (15, "shipping")):
        found[f"c{number}_missing_{role}_dates"] = _on_keyed(
            f"select count(*) as missing_{role}_dates from keyed f left join calendar d "
            f"on f.{role}_date_key = d.date_key where d.date_key is null", _CALENDAR,
        )
    missing = [f"count(*) filter (where {key} is null) as missing_{name}" for name, key in zip(COUNTED, keys)]
    missing += [
        f"count(*) filter (where {role}_date_key not in (select date_key from calendar)) as missing_{role}_dates"
        for role in ("order", "shipping")
    ]
    found["c10_missing_references"] = _on_keyed(f"select {', '.join(missing)} from keyed", _CALENDAR)
    view = _columns(
        ["order_id", "order_item_id", "customer_fname", "customer_lname", "customer_segment",
         "product_name", "category_name", "department_name", "order_city", "order_country",
         "order_region", "market", "order_status", "delivery_status", "shipping_mode",
         "late_delivery_risk", "order_item_quantity", "sales", "order_item_total",
         "order_item_discount", "order_profit_per_order", "days_for_shipping_real",
         "days_for_shipment_scheduled"], _DECIMALS,
    )
    view += (
        ", type as payment_type, cast(order_timestamp as date) as order_date, "
        "cast(shipping_timestamp as date) as shipping_date"
    )
    found["c16_star_view"] = _on_typed(f"select {view} from typed")
    found["c16_star_sample"] = _on_typed(f"select {view} from typed order by order_item_id limit 50")
    found["c17_violations"] = _on_keyed(
        " union all ".join(
            f"select '{table}' as table_name, '{constraint}' as constraint_name, '{column}' as column_name, "
            f"({sql}) as violations"
            for table, constraint, column, sql in _constraints()
        ), _CALENDAR,
    )
    rows = "(select count(*) from typed)"
    checks = [("fact_rows", rows, "(select count(*) from keyed)"),
              ("distinct_order_items", "(select count(*) from keyed)",
               "(select count(distinct order_item_id) from keyed)")]
    for table, (key, _, _) in _DIMENSIONS.items():
        name = {"dim_customer": "customers", "dim_product": "products",
                "dim_destination": "destinations", "dim_order_profile": "order_profiles"}[table]
        checks.append((f"missing_{name}", "0", f"(select count(*) from keyed where {key} is null)"))
    for role in ("order", "shipping"):
        checks.append((
            f"missing_{role}_dates", "0",
            f"(select count(*) from keyed f left join calendar d on f.{role}_date_key = d.date_key "
            "where d.date_key is null)",
        ))
        checks.append((
            f"uncovered_{role}_timestamp", "0",
            f"(select count(*) from typed t left join calendar d on cast(t.{role}_timestamp as date) = "
            "d.full_date where d.date_key is null)",
        ))
    found["c18_release_checks"] = _on_keyed(
        " union all ".join(
            f"select '{name}' as check_name, {_big(expected)} as expected, {_big(actual)} as actual, "
            f"{_big(expected)} is not distinct from {_big(actual)} as passed"
            for name, expected, actual in checks
        ), _CALENDAR,
    )
    found["c19_order_consistency"] = _on_typed(
        " union all ".join(
            f"select '{c}' as column_name, count(*) filter (where v > 1) as varying_keys from "
            f"(select count(distinct {c}) as v from typed group by order_id)"
            for c in ("delivery_status", "shipping_mode", "customer_id")
        )
    )
    found["io4_gold_tables"] = _on_keyed(
        "select 'fact_order_item' as table_name, count(*) as total_rows from keyed "
        "union all select 'dim_date', count(*) from calendar union all "
        + " union all ".join(
            f"select '{table}', count(distinct {key}) from keyed" for table, (key, _, _) in _DIMENSIONS.items()
        ), _CALENDAR,
    )
    return found


_LOSS = "order_profit_per_order < 0"
_BAND = (
    "case when order_item_discount_rate = 0 then '0%' when order_item_discount_rate <= 0.05 then '0-5%' "
    "when order_item_discount_rate <= 0.10 then '5-10%' when order_item_discount_rate <= 0.15 then '10-15%' "
    "when order_item_discount_rate <= 0.20 then '15-20%' when order_item_discount_rate <= 0.25 then '20-25%' "
    "else '25%+' end"
)
_LOSS_COUNTS = (
    f"count(*) as total_order_items, count(*) filter (where {_LOSS}) as loss_making_items, "
    f"{_pct(f'count(*) filter (where {_LOSS})', 'count(*)')} as loss_making_item_rate_pct"
)
_NEGATIVE = f"sum(order_profit_per_order) filter (where {_LOSS})"
_POSITIVE = "sum(order_profit_per_order) filter (where order_profit_per_order >= 0)"
_NET = "sum(order_profit_per_order)"
_LOSS_SALES = f"sum(sales) filter (where {_LOSS})"
_LATE = "delivery_status = 'Late Delivery'"


def _analyses() -> dict[str, str]:
    late_orders = f"count(*) filter (where {_LATE})"
    return {
        "a01_executive_kpis": _on_typed(
            f"""select {_dbl('sum(sales)')} as total_sales, {_dbl(_NET)} as net_profit,
  {_money_pct(_NET, 'sum(sales)')} as profit_margin_pct, count(distinct order_id) as total_orders,
  count(*) as total_order_items,
  {_pct(f'count(*) filter (where {_LOSS})', 'count(*)')} as loss_making_item_rate_pct,
  {_dbl(f'abs({_NEGATIVE})')} as total_negative_profit,
  (select {_money_pct('sum(abs(lost)) filter (where loss_rank <= 8)', 'sum(abs(lost))')} from ranked_losses)
    as top_8_negative_profit_share_pct,
  (select {_pct('sum(is_late)', 'count(*)')} from (
     select max(case when {_LATE} then 1 else 0 end) as is_late from typed group by order_id))
    as late_delivery_rate_pct
from typed""", _LOSSES,
        ),
        "a02_monthly_coverage": _on_keyed(
            f"""select d.year, d.month, d.month_name, count(distinct k.product_key) as distinct_products,
  count(distinct k.category_name) as distinct_categories,
  {_half_up(_cents('sum(k.sales)'), _cents('sum(k.order_item_quantity)'), 2)} as sales_per_unit,
  {_half_up('sum(k.order_item_quantity)', 'count(distinct k.order_id)', 2)} as units_per_order
from keyed k join calendar d on k.order_date_key = d.date_key
where (d.year = 2000 and d.month >= 8) or d.year = 2001
group by d.year, d.month, d.month_name""", _CALENDAR,
        ),
        "a03_loss_summary": _on_typed(
            f"""select {_LOSS_COUNTS}, {_dbl(_LOSS_SALES)} as sales_from_loss_making_items,
  {_money_pct(_LOSS_SALES, 'sum(sales)')} as loss_making_sales_share_pct,
  {_dbl(_NEGATIVE)} as total_negative_profit, {_dbl(_POSITIVE)} as positive_profit, {_dbl(_NET)} as net_profit
from typed"""
        ),
        "a04_category_loss": _on_typed(
            f"""select category_name, {_LOSS_COUNTS}, {_dbl('sum(sales)')} as total_sales,
  {_dbl(_LOSS_SALES)} as loss_making_sales, {_dbl(_NEGATIVE)} as negative_profit,
  {_dbl(_POSITIVE)} as positive_profit, {_dbl(_NET)} as net_profit
from typed group by category_name having count(*) >= 200"""
        ),
        "a05_product_loss": _on_typed(
            f"""select product_name, category_name, {_LOSS_COUNTS}, {_dbl('sum(sales)')} as total_sales,
  {_dbl(_LOSS_SALES)} as loss_making_sales, {_dbl(_NEGATIVE)} as negative_profit, {_dbl(_NET)} as net_profit
from typed group by product_name, category_name having count(*) >= 200
order by {_NEGATIVE} asc nulls last, product_name, category_name limit 20"""
        ),
        "a06_loss_pareto": _on_typed(
            f"""select loss_rank, product_name, {_dbl('lost')} as negative_profit,
  {_money_pct('abs(lost)', 'all_lost')} as negative_profit_share_pct,
  {_money_pct('lost_so_far', 'all_lost')} as cumulative_negative_profit_pct from ranked_losses""", _LOSSES,
        ),
        "a07_discount_margin": _on_typed(
            f"""select {_BAND} as discount_band, count(*) as order_items,
  {_big('sum(order_item_quantity)')} as units_sold, {_dbl('sum(sales)')} as total_sales,
  {_dbl(_NET)} as total_profit, {_money_pct(_NET, 'sum(sales)')} as profit_margin_pct
from typed group by 1"""
        ),
        "a08_discount_loss_rate": _on_typed(
            f"""select {_BAND} as discount_band, {_LOSS_COUNTS}, {_dbl('sum(sales)')} as total_sales,
  {_dbl(_NEGATIVE)} as negative_profit, {_dbl(_NET)} as net_profit from typed group by 1"""
        ),
        "a09_delivery_outcomes": _on_typed(
            f"""select delivery_status, total_orders,
  {_pct('total_orders', '(sum(total_orders) over ())')} as order_share_pct, {_dbl('s')} as total_sales,
  {_money_pct('s', 'sum(s) over ()')} as sales_share_pct,
  avg_actual_shipping_days, avg_scheduled_shipping_days, avg_schedule_variance_days
from (select delivery_status, count(*) as total_orders, sum(order_sales) as s,
  {_avg('actual')} as avg_actual_shipping_days, {_avg('scheduled')} as avg_scheduled_shipping_days,
  {_avg('variance')} as avg_schedule_variance_days from order_level group by delivery_status)""", _ORDERS,
        ),
        "a10_shipping_mode": _on_typed(
            f"""select shipping_mode, count(*) as total_orders, {late_orders} as late_orders,
  {_pct(late_orders, 'count(*)')} as late_rate_pct,
  count(*) filter (where delivery_status = 'Shipping On Time') as on_time_orders,
  count(*) filter (where delivery_status = 'Advance Shipping') as advance_orders,
  count(*) filter (where delivery_status = 'Shipping Canceled') as canceled_orders,
  {_avg('variance', "delivery_status <> 'Shipping Canceled'")} as avg_schedule_variance_days,
  {_dbl(f'sum(order_sales) filter (where {_LATE})')} as late_order_sales
from order_level group by shipping_mode""", _ORDERS,
        ),
        "a11_delay_severity": _on_typed(
            f"""select shipping_mode, count(*) as late_orders,
  count(*) filter (where variance = 1) as one_day_late, count(*) filter (where variance = 2) as two_days_late,
  count(*) filter (where variance >= 3) as three_plus_days_late,
  {_pct('count(*) filter (where variance >= 2)', 'count(*)')} as severe_delay_rate_pct,
  {_avg('variance')} as avg_delay_days, max(variance) as max_delay_days
from order_level where {_LATE} group by shipping_mode""", _ORDERS,
        ),
        "a12_customer_pareto": _on_typed(
            f"""select profit_rank, customer_id, customer_name, total_orders, {_dbl('s')} as total_sales,
  {_dbl('p')} as total_profit, {_pct('profit_rank', 'customers')} as cumulative_customer_pct,
  {_money_pct('so_far', 'company')} as cumulative_profit_pct
from (select *, row_number() over (order by p desc, customer_id) as profit_rank, count(*) over () as customers,
    sum(p) over () as company, sum(p) over (order by p desc, customer_id rows unbounded preceding) as so_far
  from (select customer_id, customer_fname || ' ' || customer_lname as customer_name,
      count(distinct order_id) as total_orders, sum(sales) as s, sum(order_profit_per_order) as p
    from typed group by customer_id, customer_fname, customer_lname))"""
        ),
        "a13_value_vs_delivery": _on_typed(
            f"""select case fifth when 1 then 'Top 20%' when 2 then '20-40%' when 3 then '40-60%'
    when 4 then '60-80%' else 'Bottom 20%' end as customer_value_group,
  count(distinct customer_id) as customers, count(*) as total_orders, {late_orders} as late_orders,
  {_pct(late_orders, 'count(*)')} as late_rate_pct, {_avg('delay', _LATE)} as avg_late_delay_days
from (select customer_id, ntile(5) over (order by sum(order_profit_per_order) desc, customer_id) as fifth
    from typed group by customer_id)
join (select order_id, customer_id, delivery_status,
    max(days_for_shipping_real) - max(days_for_shipment_scheduled) as delay
    from typed group by order_id, customer_id, delivery_status) using (customer_id)
group by fifth"""
        ),
    }


def _exact(sql: str) -> str:
    """The same result with decimals in place of doubles, as text."""
    decimals = sql.replace("as double) / 100 end", "as decimal(36,0)) * cast(0.01 as decimal(3,2)) end")
    return f"select columns(*)::varchar from ({decimals.replace('as double)', 'as decimal(38,2))')})"


def _primitives() -> dict[str, str]:
    rank = "(order by order_profit_per_order, order_item_id"
    per_profile = (
        "(select order_id, type, order_status, delivery_status, shipping_mode, late_delivery_risk, "
        "max(days_for_shipping_real) - max(days_for_shipment_scheduled) as variance from typed "
        "group by order_id, type, order_status, delivery_status, shipping_mode, late_delivery_risk)"
    )
    return {
        "p01_ratio_pct": _on_keyed(
            f"select product_key, {_money_pct(_NET, 'sum(sales)')} as profit_margin_pct "
            "from keyed group by product_key"
        ),
        "p02_loss_split": _on_keyed(
            f"select order_date_key, count(*) as total_order_items, "
            f"count(*) filter (where {_LOSS}) as loss_making_items, {_dbl('sum(sales)')} as total_sales, "
            f"{_dbl(_LOSS_SALES)} as loss_making_sales, {_dbl(_NEGATIVE)} as negative_profit, "
            f"{_dbl(_POSITIVE)} as positive_profit, {_dbl(_NET)} as net_profit from keyed group by order_date_key"
        ),
        "p03_discount_band": _on_typed(f"select order_item_id, {_BAND} as discount_band from typed"),
        "p04_order_rollup": _on_keyed(
            f"select order_id, order_profile_key, {_dbl('sum(sales)')} as order_sales, {_dbl(_NET)} as order_profit, "
            "max(days_for_shipping_real) as actual_shipping_days, "
            "max(days_for_shipment_scheduled) as scheduled_shipping_days "
            "from keyed group by order_id, order_profile_key"
        ),
        "p05_share_of_total": _on_keyed(
            f"select customer_key, {_dbl('s')} as total_sales, {_money_pct('s', 'sum(s) over ()')} as sales_share_pct "
            "from (select customer_key, sum(sales) as s from keyed group by customer_key)"
        ),
        "p06_global_cumulative": _on_typed(
            f"select order_item_id, {_dbl('order_profit_per_order')} as order_profit_per_order, "
            f"row_number() over {rank}) as profit_rank, "
            f"{_dbl(f'sum(order_profit_per_order) over {rank} rows unbounded preceding)')} as running_total, "
            f"{_dbl('sum(order_profit_per_order) over ()')} as grand_total, count(*) over () as total_rows from typed"
        ),
        "p07_global_ntile": _on_typed(
            f"select order_item_id, cast(ntile(7) over {rank}) as integer) as bucket from typed"
        ),
        "p08_topk_share": _on_typed(
            f"select {_money_pct('sum(sales) filter (where rn <= 100)', 'sum(sales)')} as top_100_share_pct "
            "from (select sales, row_number() over (order by sales desc, order_item_id) as rn from typed)"
        ),
        "p09_schedule_variance": _on_typed(
            f"select order_status, count(*) as total_orders, {_avg('variance')} as avg_variance_days, "
            f"""{_avg('variance', "delivery_status <> 'Shipping Canceled'")} """
            f"as avg_kept_variance_days from {per_profile} group by order_status"
        ),
        "p10_severity": _on_typed(
            "select type, count(*) filter (where variance = 1) as one_day_late, "
            "count(*) filter (where variance = 2) as two_days_late, "
            "count(*) filter (where variance >= 3) as three_plus_days_late, "
            f"count(*) filter (where variance >= 2) as severe_orders from {per_profile} where {_LATE} group by type"
        ),
        "io5_pruned_scan": _on_keyed(
            f"select order_date_key, {_dbl('sum(sales)')} as total_sales from keyed "
            "where order_date_key between 19980101 and 19981231 group by order_date_key"
        ),
    }


def oracle_sql() -> dict[str, str]:
    from cargolens.registry import defects

    analyses = _analyses()
    analyses |= {f"{name}_exact": _exact(sql) for name, sql in analyses.items()}
    return {**defects.oracle_sql(), **_profiles(), **_cleaning(), **_model(), **analyses, **_primitives()}
