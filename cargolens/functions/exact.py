"""Numbers written as text, compared and added without rounding.

A number of ordinary length fits a decimal and is handled as one.  Longer ones are split
into limbs: the whole part and the places, each added up as a whole number of its own, and
a text of fixed width whose order is that of the numbers.  What a column adds up to is
put together once, from a small row, in whole numbers of any size.  Text that is no number,
or has more digits than the limbs hold, fails the job: nothing is cut.  Numbers in
exponent form are read as decimals of 18 places.
"""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, functions as F, types as T

from cargolens.functions.parsing import failure

WHOLE, PLACES = 36, 25  # digits that the limbs hold
_SHORT = 15  # characters of an ordinary number, so at most 15 digits before and 14 behind the point
_ORDINARY = T.DecimalType(29, 14)
_LIMB = T.DecimalType(38, 0)
_PLAIN = r"^[+-]?(\d+\.?\d*|\.\d+)$"
_DIGITS = "0123456789"


def _has_exponent(text: Column) -> Column:
    return F.contains(text, F.lit("e")) | F.contains(text, F.lit("E"))


def _is_ordinary(text: Column) -> Column:
    return (F.octet_length(text) <= _SHORT) & ~_has_exponent(text)


def ordinary_totals(name: str) -> dict[str, Column]:
    """Aggregates of a text column over its ordinary numbers, and how many others there are.

    Blank text is no number and fails; NULL counts for nothing.
    """
    text = F.col(name)
    read = F.coalesce(text.try_cast(_ORDINARY), F.when(text.isNotNull(), failure(name)))
    value = F.when(_is_ordinary(text), read)
    return {
        "ordinary": F.count(value),
        "others": F.count_if(~_is_ordinary(text)),
        "least": F.min(value),
        "most": F.max(value),
        "total": F.sum(value),
    }


def long_totals(name: str) -> dict[str, Column]:
    """The same over the other numbers of the column, in limbs."""
    given = F.trim(F.col(name))
    as_decimal = given.try_cast(T.DecimalType(38, 18)).cast("string")
    given = F.when(_has_exponent(given), as_decimal).otherwise(given)
    whole = F.regexp_replace(F.regexp_extract(given, r"^[+-]?(\d*)", 1), "^0+", "")
    places = F.regexp_replace(F.regexp_extract(given, r"\.(\d*)$", 1), "0+$", "")
    readable = given.rlike(_PLAIN) & (F.length(whole) <= WHOLE) & (F.length(places) <= PLACES)
    negative = F.startswith(given, F.lit("-"))
    sign = F.when(negative, -1).otherwise(1)
    digits = F.concat(F.lpad(whole, WHOLE, "0"), F.rpad(places, PLACES, "0"))
    # Text of fixed width, ordered like the numbers.
    key = F.when(negative, F.concat(F.lit("0"), F.translate(digits, _DIGITS, _DIGITS[::-1]))).otherwise(
        F.concat(F.lit("1"), digits)
    )

    def of(part: Column) -> Column:
        return F.when(~_is_ordinary(F.col(name)), F.when(readable, part).otherwise(failure(name)))

    return {
        "least": F.min(of(key)),
        "most": F.max(of(key)),
        "whole": F.sum(of(F.concat(F.lit("0"), whole).cast(_LIMB) * sign)),
        "rest": F.sum(of(F.rpad(places, PLACES, "0").cast(_LIMB) * sign)),
    }


def _plain(units: int, places: int) -> str:
    """``units`` of the last place as text."""
    digits = str(abs(units)).rjust(places + 1, "0")
    point = len(digits) - places
    text = f"{digits[:point]}.{digits[point:]}" if places else digits
    return f"-{text}" if units < 0 else text


def _shortest(units: int) -> str:
    return _plain(units, PLACES).rstrip("0").rstrip(".")


def _units(value: Decimal) -> int:
    """A decimal in units of the last place that limbs hold."""
    numerator, denominator = value.as_integer_ratio()
    return numerator * 10**PLACES // denominator


def _units_of_key(key: str) -> int:
    digits = key[1:]
    return int(digits) if key[0] == "1" else -int(digits.translate(str.maketrans(_DIGITS, _DIGITS[::-1])))


def summary(
    ordinary: Mapping, long: Mapping | None, mean_places: int
) -> tuple[str | None, str | None, str | None]:
    """Lowest, highest and mean of a column as text, from its totals.

    The mean is rounded half away from zero, once.
    """
    count, total, ends = ordinary["ordinary"], 0, []
    if count:
        if ordinary["total"] is None:
            raise OverflowError("the sum of the numbers is too long")
        total += _units(ordinary["total"])
        ends += [_units(ordinary["least"]), _units(ordinary["most"])]
    if long:
        count += ordinary["others"]
        total += int(long["whole"]) * 10**PLACES + int(long["rest"])
        ends += [_units_of_key(long["least"]), _units_of_key(long["most"])]
    if not count:
        return None, None, None
    base = 2 * count * 10**PLACES
    mean = (2 * abs(total) * 10**mean_places + base // 2) // base
    return _shortest(min(ends)), _shortest(max(ends)), _plain(-mean if total < 0 else mean, mean_places)
