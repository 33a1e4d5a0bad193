"""Quotients against exact fractions."""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from cargolens.functions.numbers import mean, ratio, ratio_pct

HUNDREDTHS = Decimal("0.01")


def exact(numerator, denominator, factor=1):
    if not denominator:
        return None
    hundredths = Fraction(numerator) * factor * 100 / Fraction(denominator)
    whole = (2 * abs(hundredths) + 1) // 2  # half away from zero
    return Decimal(int(whole if hundredths >= 0 else -whole)) * HUNDREDTHS


def test_a_quotient_just_below_half_a_cent_is_not_rounded_up(spark):
    row = spark.range(1).select(
        ratio_pct(F.lit(Decimal("999999999.99")), F.lit(Decimal("20000000000000.00"))).alias("r")
    ).first()
    assert row["r"] == Decimal("0.00")


def test_four_decimals_are_not_rounded_first(spark):
    row = spark.range(1).select(ratio(F.lit(Decimal("0.0049")), F.lit(Decimal("0.0010"))).alias("r")).first()
    assert row["r"] == Decimal("4.90")


pairs = st.tuples(
    st.integers(-(10**16), 10**16), st.integers(-(10**16), 10**16).filter(lambda d: d == 0 or abs(d) > 10**3)
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(pairs, min_size=1, max_size=40), st.sampled_from([0, 2, 4]))
def test_same_as_fractions(spark, values, scale):
    unit = Decimal(1).scaleb(-scale)
    rows = [(Decimal(n) * unit, Decimal(d) * unit, n % 10**12, abs(d) % 10**9) for n, d in values]
    schema = f"n decimal(20,{scale}), d decimal(20,{scale}), total long, count long"
    found = spark.createDataFrame(rows, schema).select(
        "*", ratio(F.col("n"), F.col("d")).alias("r"), ratio_pct(F.col("n"), F.col("d")).alias("p"),
        mean(F.col("total"), F.col("count")).alias("m"),
    )
    for row in found.collect():
        assert row["r"] == exact(row["n"], row["d"])
        assert row["p"] == exact(row["n"], row["d"], 100)
        assert row["m"] == exact(row["total"], row["count"])
