"""Rows whose keys refer to nothing, counted for many keys in one scan.

Surrogate keys are numbered without gaps, so a key refers to a row if it lies between the
smallest and the greatest one.  Where a table's keys do have gaps (a calendar's between
months, or rows that are lost), a bitmap over the range tells which keys there are.  Both
are constants of one aggregate, so no key is shuffled, however hot.  Keys that are spread
too far for a bitmap are counted by an anti join instead.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from cargolens.operators.joins import unmatched_keys

MOST_BITS = 1 << 22  # half a megabyte; calendars of a century span a quarter of it
_WORD = 63  # bits of a long that are used, so that none is negative


@dataclass(frozen=True)
class Reference:
    """Column ``key`` of the rows refers to ``column`` of ``table``, both whole numbers."""

    key: str
    table: DataFrame
    column: str


@dataclass(frozen=True)
class KnownKeys:
    """The keys of a table: all from ``least`` to ``most``, or those whose bits are set."""

    least: int | None
    most: int | None
    words: list[int] | None = None

    def holds(self, key: Column) -> Column:
        if self.least is None:
            return F.lit(False)
        key = key.cast("long")
        inside = F.coalesce(key.between(self.least, self.most), F.lit(False))
        if self.words is None:
            return inside
        # One text constant, which the optimizer turns into an array once.
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<long>")
        place = key - self.least
        word = F.get(words, F.floor(place / _WORD).cast("int"))
        bit = F.call_function("shiftright", word, (place % _WORD).cast("int")).bitwiseAND(F.lit(1))
        return inside & F.coalesce(bit == 1, F.lit(False))


def known_keys(references: Sequence[Reference], most_bits: int = MOST_BITS) -> list[KnownKeys | None]:
    """The keys of each table; None where they are too many to say.

    One job finds which tables have no gaps; each other one is read once more.
    """
    bounds = None
    for i, ref in enumerate(references):
        key = F.col(ref.column).cast("long")
        found = ref.table.agg(
            F.lit(i).alias("i"), F.min(key).alias("least"), F.max(key).alias("most"),
            F.count_distinct(key).alias("n"),
        )
        bounds = found if bounds is None else bounds.unionByName(found)
    rows = {r["i"]: r for r in bounds.collect()} if bounds is not None else {}
    out: list[KnownKeys | None] = []
    for i, ref in enumerate(references):
        least, most, n = rows[i]["least"], rows[i]["most"], rows[i]["n"]
        if n == 0 or most - least + 1 == n:
            out.append(KnownKeys(least, most))
        elif most - least < most_bits:
            out.append(KnownKeys(least, most, _bitmap(ref, least, most)))
        else:
            out.append(None)
    return out


def _bitmap(ref: Reference, least: int, most: int) -> list[int]:
    place = F.col("k") - least
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (place % _WORD).cast("int"))
    keys = ref.table.select(F.col(ref.column).cast("long").alias("k")).where("k IS NOT NULL")
    found = keys.groupBy(F.floor(place / _WORD).alias("word")).agg(F.bit_or(bit).alias("bits"))
    words = [0] * ((most - least) // _WORD + 1)
    for row in found.collect():  # at most MOST_BITS / 63 rows
        words[row["word"]] = row["bits"]
    return words


def missing_references(
    rows: DataFrame, references: Mapping[str, Reference], *also: Column, most_bits: int = MOST_BITS
) -> DataFrame:
    """One row: for each name, how many rows refer to nothing; NULL refers to nothing.

    ``also`` holds further aggregates of the same scan.
    """
    known = known_keys(list(references.values()), most_bits)
    counts, joined = [], {}
    for (name, ref), keys in zip(references.items(), known):
        if keys is None:
            joined[name] = unmatched_keys(rows, ref.table, [(ref.key, ref.column)])
        else:
            counts.append(F.count_if(~keys.holds(F.col(ref.key))).alias(name))
    found = rows.agg(*also, *(counts or [F.lit(0).alias("__none")]))
    for name, frame in joined.items():
        total = frame.agg(F.coalesce(F.sum("row_count"), F.lit(0)).cast("long").alias("n"))
        found = found.withColumn(name, total.scalar())
    others = [c for c in found.columns if c not in references and c != "__none"]
    return found.select(*others, *references)
