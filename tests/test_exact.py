from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from cargolens.operators import profiling as P


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string").repartition(3)


def ranged(spark, values, places=6):
    return tuple(P.numeric_range(frame(spark, values), "v", "a", "b", "m", places).first())


def wanted(values, places=6):
    with localcontext(prec=200):
        numbers = [Decimal(v.strip()) for v in values if v is not None]
        mean = (abs(sum(numbers)) / len(numbers)).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP)
        shortest = lambda d: f"{d:f}".rstrip("0").rstrip(".") if "." in f"{d:f}" else f"{d:f}"
        zero = lambda t: "0" if Decimal(t) == 0 else t
        return zero(shortest(min(numbers))), zero(shortest(max(numbers))), f"{'-' if sum(numbers) < 0 and mean else ''}{mean:f}"


def _number(rng, whole, places):
    text = "".join(rng.choices("0123456789", k=rng.randint(1, whole)))
    if rng.random() < 0.7:
        text += "." + "".join(rng.choices("0123456789", k=rng.randint(1, places)))
    return rng.choice(["", "", "-", "+"]) + text


@pytest.mark.parametrize("whole, places", [(4, 2), (16, 16), (30, 25)])
@pytest.mark.parametrize("digits", [0, 6, 12])
def test_same_as_arithmetic_of_any_precision(spark, whole, places, digits):
    rng = random.Random(whole * 31 + digits)
    values = [_number(rng, whole, places) for _ in range(150)] + [None, " 12.50 ", "007", "5."]
    assert ranged(spark, values, digits) == wanted(values, digits)


def test_thirty_digits_and_twenty_five_places_survive(spark):
    long = "1" * 30 + "." + "2" * 24 + "3"
    assert ranged(spark, [long, "-" + long, "1"], 3) == ("-" + long, long, "0.333")
    assert ranged(spark, ["0." + "0" * 24 + "1", "0"], 25)[1:] == ("0." + "0" * 24 + "1", "0." + "0" * 24 + "1")


@pytest.mark.parametrize("value", ["", " ", "x", "1,5", "1.2.3", "9" * 37, "0." + "1" * 26, "1e5x", "9" * 20 + "x"])
def test_what_is_no_number_or_too_long_fails(spark, value):
    with pytest.raises(Exception, match="column v"):
        ranged(spark, ["1", value])


def test_exponents_are_read_as_decimals(spark):
    assert ranged(spark, ["1e3", "2E-2", "0e0"], 2) == ("0", "1000", "333.34")


def test_only_columns_with_long_numbers_are_read_again(spark, monkeypatch):
    rows = spark.createDataFrame([("1", "2" * 30), ("3", "4")], "a string, b string")
    calls = []
    real = P._by_column
    monkeypatch.setattr(P, "_by_column", lambda df, names, measures: (calls.append(list(names)), real(df, names, measures))[1])
    found = {r["column_name"]: r["highest"] for r in P.numeric_profile(rows, ["a", "b"]).collect()}
    assert calls == [["a", "b"], ["b"]] and found == {"a": "3", "b": "2" * 30}


def test_halves_are_rounded_away_from_zero(spark):
    assert ranged(spark, ["1", "2"], 0)[2] == "2" and ranged(spark, ["-1", "-2"], 0)[2] == "-2"
    assert ranged(spark, [None, None]) == (None, None, None) and ranged(spark, []) == (None, None, None)


def test_profile_of_many_columns(spark):
    rows = spark.createDataFrame([("1", "2.5", None), ("3", "-2.5", None)], "a string, b string, c string")
    found = {r["column_name"]: tuple(r)[1:] for r in P.numeric_profile(rows, ["a", "b", "c"], 2).collect()}
    assert found == {"a": ("1", "3", "2.00"), "b": ("-2.5", "2.5", "0.00"), "c": (None, None, None)}


def test_distinct_samples_shuffle_few_rows(spark):
    rng = random.Random(2)
    values = [rng.choice([None, "é", "Z", "a", str(rng.randrange(5000))]) for _ in range(3000)] + ["0"] * 3000
    rows = frame(spark, values)
    want = sorted({v for v in values if v is not None}, key=lambda v: v.encode())[:20]
    assert [r["v"] for r in P.distinct_sample(rows, "v").collect()] == want
    assert [r["v"] for r in P.distinct_sample(frame(spark, [None, "b", None]), "v").collect()] == ["b", None]
    assert P.distinct_sample(frame(spark, []), "v").collect() == []
    in_tasks = P._first_values(rows.select("v"), 20).groupBy(F.spark_partition_id()).count().collect()
    assert len(in_tasks) == 3 and all(r["count"] <= 20 for r in in_tasks)


def test_sketches_merge_and_keep_their_error(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 7).alias("part"), F.col("id").cast("string").alias("a"),
        (F.col("id") % 11).cast("string").alias("b"), F.lit(None).cast("string").alias("c"),
    )
    columns = ["a", "b", "c"]
    parts = P.distinct_sketches(rows, columns, "part")
    assert parts.count() == 7
    found = {r["column_name"]: r for r in P.sketched_counts(parts, columns).collect()}
    assert abs(found["a"]["distinct_values"] - 60_000) <= 60_000 * 3 * found["a"]["standard_error"]
    assert found["b"]["distinct_values"] == 11 and found["c"]["distinct_values"] == 0
    assert found["a"]["standard_error"] < 0.01
