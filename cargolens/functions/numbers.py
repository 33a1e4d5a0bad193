"""Exact ratios, averages and bands.  All arithmetic is decimal or whole-number."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F

# Any 64-bit number of hundredths.
_REPORTED = "decimal(21,2)"

# Upper ends (inclusive) and labels of the discount bands.
DISCOUNT_BANDS = [
    ("0.05", "0-5%"),
    ("0.10", "5-10%"),
    ("0.15", "10-15%"),
    ("0.20", "15-20%"),
    ("0.25", "20-25%"),
]
NO_DISCOUNT, DEEPEST_DISCOUNT = "0%", "25%+"


def ratio(numerator: Column, denominator: Column, factor: int = 1) -> Column:
    """``numerator * factor / denominator`` to two places, NULL for a zero base.

    Both are decimals of any scale, or whole numbers.  The quotient is rounded once,
    half away from zero, as a whole number of hundredths: a decimal quotient would be
    rounded to its type first and then again.
    """
    above, base = F.abs(numerator), F.abs(F.nullif(denominator, F.lit(0)))
    doubled = above * F.lit(Decimal(200 * factor)) + base
    hundredths = F.call_function("div", doubled, base * F.lit(Decimal(2)))
    signed = F.when((numerator < 0) != (denominator < 0), -hundredths).otherwise(hundredths)
    return (signed * F.lit(Decimal("0.01"))).cast(_REPORTED)


def ratio_pct(part: Column, whole: Column) -> Column:
    return ratio(part, whole, 100)


def money(total: Column) -> Column:
    """Two places, with as many whole digits as the total's type has."""
    return F.round(total, 2)


def mean(total: Column, count: Column) -> Column:
    """Mean from a sum and a count, to two places."""
    return ratio(total, count)


def discount_band(rate: Column) -> Column:
    """Right-closed bands; a missing rate falls through to the deepest one."""
    band = F.when(rate == 0, NO_DISCOUNT)
    for upper, label in DISCOUNT_BANDS:
        band = band.when(rate <= F.lit(upper).cast("decimal(8,4)"), label)
    return band.otherwise(DEEPEST_DISCOUNT)
