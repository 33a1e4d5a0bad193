from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cargolens.functions import dates, numbers, parsing, text
from cargolens.schemas import INT, MONEY


def column(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in rows.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def test_timestamps_are_searched_once(spark):
    given = ["1/31/2018 22:56", " 01/31/2018 2:06 ", "", " ", None, "2018-01-31 22:56", "now", "12:30", "x 1/31/2018 22:56"]
    read = spark.createDataFrame([(v,) for v in given], "x string").select(parsing.read_us_timestamp(F.col("x")).alias("y"))
    first, second = dt.datetime(2018, 1, 31, 22, 56), dt.datetime(2018, 1, 31, 2, 6)
    assert [r["y"] for r in read.collect()] == [first, second] + [None] * 7
    assert "RLIKE" not in read._jdf.queryExecution().optimizedPlan().toString()


def test_title_case_starts_words_after_any_other_character(spark):
    given = ["women's apparel", "indoor/outdoor GAMES", "éCOLE\tx", "3d 4TH_x", "a  b", "", None,
             "x y", "o'brien-smith", " lead"]
    wanted = ["Women'S Apparel", "Indoor/Outdoor Games", "École\tX", "3d 4th_X", "A  B", "", None,
              "X Y", "O'Brien-Smith", " Lead"]
    assert column(spark, given, "string", text.title_case) == wanted
    assert column(spark, ["women's apparel"], "string", lambda c: text.title_case(c, "whitespace")) == [
        "Women's Apparel"
    ]
    with pytest.raises(ValueError):
        text.title_case(F.lit("x"), "other")


def test_status_blank_and_spaces(spark):
    assert column(spark, [" PENDING_PAYMENT ", None], "string", text.readable_status) == ["Pending Payment", None]
    assert column(spark, ["  ", "", None, " a "], "string", text.blank_to_null) == [None, None, None, "a"]
    assert column(spark, [" a", "a", None], "string", text.has_outer_spaces) == [True, False, None]
    joined = lambda c: text.concat_skip_nulls(c, F.lit("|"), F.lit("z"))
    assert column(spark, [None, "a"], "string", joined) == ["|z", "a|z"]


def test_timestamps_padded_or_not(spark):
    given = ["1/31/2018 22:56", "01/03/2018 02:06", " 1/3/2018 2:06 ", "", None, "2018-01-31 22:56",
             "13/31/2018 22:56", "2/30/2018 1:00", "1/3/18 2:06"]
    wanted = [dt.datetime(2018, 1, 31, 22, 56), dt.datetime(2018, 1, 3, 2, 6), dt.datetime(2018, 1, 3, 2, 6),
              None, None, None, None, None, None]
    assert column(spark, given, "string", parsing.read_us_timestamp) == wanted
    flags = column(spark, given, "string", lambda c: parsing.unreadable(c, parsing.read_us_timestamp(c)))
    assert flags == [False] * 5 + [True] * 4


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_strict_casts_do_not_depend_on_the_session(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        read = lambda t: lambda c: parsing.or_fail(c, parsing.read_as(c, t), "x")
        assert column(spark, [" 5 ", "", None, "-7"], "string", read(INT)) == [5, None, None, -7]
        assert column(spark, ["314.645", "-0.125", "2.004"], "string", read(MONEY)) == [
            Decimal("314.65"), Decimal("-0.13"), Decimal("2.00")
        ]
        for bad, kind in (("3.0", INT), ("abc", INT), ("99999999999.00", MONEY)):
            with pytest.raises(Exception, match="column x"):
                column(spark, [bad], "string", read(kind))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_ratios_round_half_away_from_zero(spark):
    rows = spark.createDataFrame(
        [(1, 3), (-1, 3), (1, 0), (None, 3), (1, 800), (-1, 800), (0, 5)], "a long, b long"
    )
    got = [r[0] for r in rows.select(numbers.ratio_pct(F.col("a"), F.col("b"))).collect()]
    assert got == [Decimal("33.33"), Decimal("-33.33"), None, None, Decimal("0.13"), Decimal("-0.13"), Decimal("0.00")]
    means = rows.select(numbers.mean(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in means][:3] == [Decimal("0.33"), Decimal("-0.33"), None]


def test_discount_bands_are_right_closed(spark):
    given = [Decimal(x) for x in ("0", "0.0001", "0.05", "0.0501", "0.10", "0.15", "0.2", "0.25", "0.2501", "-0.01")]
    given.append(None)
    assert column(spark, given, "decimal(8,4)", numbers.discount_band) == [
        "0%", "0-5%", "0-5%", "5-10%", "5-10%", "10-15%", "15-20%", "20-25%", "25%+", "0-5%", "25%+"
    ]


def test_calendar_columns(spark):
    day = spark.sql("select explode(array(date'2017-01-01', date'2018-02-06')) as d")
    rows = [r.asDict() for r in day.select(*dates.calendar_columns(F.col("d"))).orderBy("date_key").collect()]
    assert rows[0] == {
        "date_key": 20170101, "full_date": dt.date(2017, 1, 1), "year": 2017, "quarter": 1, "month": 1,
        "month_name": "January", "week_of_year": 52, "day": 1, "day_name": "Sunday", "is_weekend": True,
    }
    assert (rows[1]["month_name"], rows[1]["day_name"], rows[1]["is_weekend"]) == ("February", "Tuesday", False)
