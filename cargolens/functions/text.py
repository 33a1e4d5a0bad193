"""Text rules of the cleaning step, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Blanks already separate words for ``initcap``; every other character that is
# neither letter nor digit is followed by this marker while it runs.  The marker
# starts with such a character itself, so removing it restores any text exactly.
_SEPARATOR = r"([^\p{L}\p{N} ])"
_MARKER = "\uE000 "


def blank_to_null(text: Column) -> Column:
    """Trim outer spaces; text that is empty afterwards becomes NULL."""
    return F.nullif(F.trim(text), F.lit(""))


def title_case(text: Column, style: str = "alphanumeric") -> Column:
    """Capitalise each word and lower the rest.

    ``alphanumeric`` starts a word after any character that is neither letter
    nor digit (``women's`` -> ``Women'S``, ``indoor/outdoor`` ->
    ``Indoor/Outdoor``).  ``whitespace`` starts words after blanks only.
    """
    if style == "whitespace":
        return F.initcap(text)
    if style != "alphanumeric":
        raise ValueError(f"unknown title-case style: {style}")
    marked = F.regexp_replace(text, _SEPARATOR, "$1" + _MARKER)
    split = F.replace(F.initcap(marked), F.lit(_MARKER), F.lit(""))
    return F.when(text.rlike(_SEPARATOR), split).otherwise(F.initcap(text))


def readable_status(text: Column) -> Column:
    """``PENDING_PAYMENT`` -> ``Pending Payment``."""
    return title_case(F.replace(F.trim(text), F.lit("_"), F.lit(" ")))


def concat_skip_nulls(*parts: Column) -> Column:
    """Concatenate, reading NULL parts as empty text."""
    return F.concat(*[F.coalesce(part, F.lit("")) for part in parts])


def has_outer_spaces(text: Column) -> Column:
    return text != F.trim(text)
