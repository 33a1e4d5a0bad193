"""Cleaning: one declared rule per target column, compiled to one ``select``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from cargolens import schemas as S
from cargolens.functions import parsing, text

TITLE, STATUS, UPPER, KEEP, BLANK_NULL, TYPED, MOMENT = (
    "title", "status", "upper", "keep", "blank_null", "typed", "moment",
)


MOST_IN_ONE_METHOD = 8  # rules; more take the JVM beyond what it compiles


@dataclass(frozen=True)
class Rule:
    """How one target column is made from one raw column."""

    target: str
    kind: str
    data_type: T.DataType = S.TEXT
    max_length: int | None = None
    source: str | None = None

    @property
    def raw(self) -> Column:
        return F.col(self.source or self.target)

    def value(self) -> Column:
        """The target value; NULL where typed text cannot be read."""
        makers = {
            TITLE: lambda: text.title_case(F.trim(self.raw)),
            STATUS: lambda: text.readable_status(self.raw),
            UPPER: lambda: F.upper(F.trim(self.raw)),
            KEEP: lambda: F.trim(self.raw),
            BLANK_NULL: lambda: text.blank_to_null(self.raw),
            TYPED: lambda: parsing.read_as(self.raw, self.data_type),
            MOMENT: lambda: parsing.read_us_timestamp(self.raw),
        }
        return makers[self.kind]()

    def broken(self, value: Column) -> Column:
        """Whether ``value`` breaks the rule: unreadable, or longer than allowed."""
        if self.max_length is not None:
            return parsing.too_long(value, self.max_length)
        return parsing.unreadable(self.raw, value)

    def strict_value(self) -> Column:
        if self.kind in (TYPED, MOMENT):
            return parsing.or_fail(self.raw, self.value(), self.target)
        return self.value()


def _typed(data_type: T.DataType, *names: str) -> dict[str, Rule]:
    return {name: Rule(name, TYPED, data_type) for name in names}


def _text(kind: str, max_length: int, *names: str) -> dict[str, Rule]:
    return {name: Rule(name, kind, max_length=max_length) for name in names}


def _moment(target: str, source: str) -> dict[str, Rule]:
    return {target: Rule(target, MOMENT, S.TIMESTAMP, source=source)}


# Cleaning rule, type and greatest length of each column.
_RULES: dict[str, Rule] = {
    **_text(TITLE, 50, "type", "delivery_status"),
    **_text(TITLE, 100, "customer_country", "customer_fname", "customer_lname",
            "customer_segment", "order_country", "shipping_mode"),
    **_text(TITLE, 150, "category_name", "customer_city", "department_name",
            "order_city", "order_state"),
    **_text(STATUS, 100, "order_status"),
    **_text(UPPER, 100, "customer_state"),
    **_text(KEEP, 100, "market"),
    **_text(KEEP, 150, "order_region"),
    **_text(KEEP, 255, "customer_street", "product_name"),
    **_text(BLANK_NULL, 30, "customer_zipcode"),
    **_typed(S.ID, "customer_id", "order_customer_id", "order_id", "order_item_id",
             "order_item_cardprod_id", "product_card_id"),
    **_typed(S.INT, "days_for_shipping_real", "days_for_shipment_scheduled",
             "category_id", "department_id", "order_item_quantity", "product_category_id"),
    **_typed(S.SHORT, "late_delivery_risk"),
    **_typed(S.MONEY, "benefit_per_order", "sales_per_customer", "order_item_discount",
             "order_item_product_price", "sales", "order_item_total",
             "order_profit_per_order", "product_price"),
    **_typed(S.RATE, "order_item_discount_rate", "order_item_profit_ratio"),
    **_typed(S.COORDINATE, "latitude", "longitude"),
    **_moment("order_timestamp", "order_date"),
    **_moment("shipping_timestamp", "shipping_date"),
}

_RENAMED = {"order_date": "order_timestamp", "shipping_date": "shipping_timestamp"}

# The raw columns in file order, minus the excluded ones.
RULES = [
    _RULES[_RENAMED.get(name, name)]
    for name in S.BRONZE_COLUMNS
    if name not in S.EXCLUDED_COLUMNS
]
SILVER = T.StructType([T.StructField(rule.target, rule.data_type) for rule in RULES])


def clean(bronze: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Typed rows, one per raw row; text without a value of its type fails the job.

    Lengths are a constraint of the table: see ``quality.silver_violations``.
    """
    values = [rule.strict_value() for rule in rules]
    if len(rules) > MOST_IN_ONE_METHOD:
        values[0] = _in_small_methods(values[0], rules[0])
    return bronze.select(*[value.alias(rule.target) for value, rule in zip(values, rules)])


def _in_small_methods(value: Column, rule: Rule) -> Column:
    """``value``, in a projection or filter that is not compiled into one method.

    The JVM runs the one method that all rules make uncompiled, as it is too long.  The condition is
    always met, but has no generated code, so Spark generates a method for each part instead,
    whatever the settings of the session that runs the query.
    """
    met = F.exists(F.array(F.lit(True), rule.raw.isNull()), lambda x: x)
    return F.when(met, value)


def clean_or_quarantine(bronze: DataFrame, rules: list[Rule] = RULES) -> tuple[DataFrame, DataFrame]:
    """Rows that satisfy every rule, and the raw rest with its broken columns."""
    # A filter of the array would interpret all rules, as it has no generated code.
    names = [F.when(rule.broken(rule.value()), F.lit(rule.target)).otherwise(F.lit("")) for rule in rules]
    broken = _in_small_methods(F.array_remove(F.array(*names), ""), rules[0])
    judged = bronze.withColumn("broken_columns", broken)
    accepted = judged.where(F.size("broken_columns") == 0).select(
        *[rule.value().alias(rule.target) for rule in rules]
    )
    return accepted, judged.where(F.size("broken_columns") > 0)


def rules_of(kind: str, *data_types: T.DataType) -> list[Rule]:
    """The rules of one kind, optionally of some result types only."""
    return [
        rule for rule in RULES
        if rule.kind == kind and (not data_types or rule.data_type in data_types)
    ]
