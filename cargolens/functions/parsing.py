"""Text to typed values.

``read_*`` yields NULL both for blank text and for text that has no value of
the type.  ``unreadable`` tells the two apart; ``or_fail`` makes the second
one fail the job, whatever the session's ANSI setting.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# Fixed value: month/day/year hour:minute, each part of one or two digits.
US_TIMESTAMP = r"^(\d{1,2})/(\d{1,2})/(\d{4}) (\d{1,2}):(\d{1,2})$"


def read_as(text: Column, data_type: T.DataType) -> Column:
    """NULL for blank text; decimals round half away from zero.

    The cast itself ignores outer spaces and has no value for blank text.
    """
    return text.try_cast(data_type)


def read_us_timestamp(text: Column) -> Column:
    """``1/31/2018 22:56`` (padded or not) to a timestamp without zone."""
    # Other text gets the replacement without its groups in front, so that it has no value.
    iso = F.regexp_replace(F.trim(text), f"{US_TIMESTAMP}|^", "$3-$1-$2 $4:$5")
    return iso.try_cast(T.TimestampNTZType())


def unreadable(text: Column, value: Column) -> Column:
    return F.coalesce(value.isNull() & (F.trim(text) != ""), F.lit(False))


def too_long(value: Column, limit: int) -> Column:
    return F.coalesce(F.char_length(value) > limit, F.lit(False))


def failure(label: str) -> Column:
    return F.raise_error(F.lit(f"cleaning rule failed for column {label}"))


def or_fail(text: Column, value: Column, label: str) -> Column:
    """``value``, or an error where non-blank text produced none."""
    return F.coalesce(value, F.when(F.trim(text) != "", failure(label)))


def numeric(name: str) -> Column:
    """A raw text column as an exact number, failing on any text that is none."""
    text = F.col(name)
    value = text.try_cast(T.DecimalType(38, 18))
    return F.coalesce(value, F.when(text.isNotNull(), failure(name)))


def us_timestamp(name: str) -> Column:
    text = F.col(name)
    return or_fail(text, read_us_timestamp(text), name)
