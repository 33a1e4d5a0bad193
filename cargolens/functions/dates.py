"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def date_key(moment: Column) -> Column:
    """``YYYYMMDD`` as an integer."""
    day = F.to_date(moment)
    return F.year(day) * 10_000 + F.month(day) * 100 + F.dayofmonth(day)


def calendar_columns(day: Column) -> list[Column]:
    """Attributes of one calendar day; weeks are ISO weeks, the year is not."""
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "EEEE").alias("day_name"),
        (F.weekday(day) >= 5).alias("is_weekend"),
    ]
