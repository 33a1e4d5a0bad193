"""Global ordering with one exchange of the rows and no window over all of them.

A window that orders the whole input runs in one task.  Here the rows are dealt into
ranges of the sort key:

1. A bounded sample of keys gives cut points over the whole key, ties included, so a
   value that a third of all rows share still spreads as long as later columns differ.
2. Rows are counted, and the value is added up, per range before anything is shuffled.
   One small row per range then tells what comes before it.
3. The rows are shuffled once, by range number, one range to a task.  A window over
   each range gives local rank and running sum together; what comes before is added as
   constants.  Ranges follow each other in order, so the result comes sorted.

The key columns are read three times and the rows once.  An input that is more than a
filtered or projected table is written first, so it is computed once.

``ranked_lookup`` joins a table on the first sort column in the same exchange: the table's
rows go to the ranges that their key falls in, so the rows are not shuffled again for it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import localcontext
from itertools import accumulate
from math import ceil

from pyspark.sql import Column, DataFrame, Row, Window, functions as F, types as T

from cargolens.workspace import Workspace, reads_a_table

_RANGE = "__range"
MOST_RANGES = 4096  # cut points are constants of the plan
ROWS_PER_RANGE = 100_000  # smaller inputs get fewer ranges than there are partitions
MOST_PER_RANGE = 500_000  # larger inputs get more, so that a range is sorted in memory
_SAMPLED_PER_RANGE = 40


@dataclass(frozen=True)
class _Key:
    """A sorted column: its name, direction and where NULLs go."""

    name: str
    descending: bool
    nulls_first: bool

    @classmethod
    def of(cls, column: Column, df: DataFrame) -> _Key:
        found = re.fullmatch(r"Column<'(.+?)(?: (ASC|DESC) NULLS (FIRST|LAST))?'>", str(column))
        if not found or found[1] not in df.columns:
            raise ValueError(f"{column} is no column of the input, such as 'a' or F.col('a').desc()")
        return cls(found[1], found[2] == "DESC", found[3] != "LAST")

    def after(self, cut: Column) -> Column:
        """Whether the column's value comes after ``cut``."""
        value = F.col(self.name)
        beyond = value < cut if self.descending else value > cut
        if self.nulls_first:
            return F.coalesce(beyond, cut.isNull() & value.isNotNull())
        return F.coalesce(beyond, value.isNull() & cut.isNotNull())


def _literals(values: Sequence, data_type: T.DataType) -> Column:
    """An array of constants, which the optimizer folds into one."""

    def constant(value) -> Column:
        if value is not None and isinstance(data_type, T.TimestampNTZType):
            value = value.isoformat(sep=" ")
        return F.lit(value).cast(data_type)

    return F.array(*map(constant, values))


def _cut_points(df: DataFrame, order: Sequence[Column], keys: Sequence[_Key], total: int, ranges: int) -> list[Row]:
    """Keys that divide the rows into about ``ranges`` equal parts, in order."""
    if ranges < 2:
        return []
    fraction = min(1.0, 1.2 * ranges * _SAMPLED_PER_RANGE / total)
    names = list(dict.fromkeys(key.name for key in keys))
    sample = df.select(*names).sample(fraction, seed=17)
    # The sample is small, whatever the input: some rows for each range.
    rows = sample.repartition(1).sortWithinPartitions(*order).collect()
    step = len(rows) / ranges
    cuts = [rows[int(step * i)] for i in range(1, ranges)] if rows else []
    return [cut for i, cut in enumerate(cuts) if i == 0 or cut != cuts[i - 1]]


def _range_number(
    df: DataFrame, keys: Sequence[_Key], cuts: Sequence[Row], inclusive: bool = True
) -> Column:
    """How many cut points a row's key has reached (or passed), by binary search.

    The first column alone tells it for most rows; the others are compared only for rows
    that share its value with a cut point.
    """
    if not cuts:
        return F.lit(0)
    arrays = {key.name: _literals([cut[key.name] for cut in cuts], df.schema[key.name].dataType) for key in keys}

    def reached(i: Column) -> Column:
        result = F.lit(inclusive)
        for key in reversed(keys):
            cut = F.get(arrays[key.name], i)
            result = key.after(cut) | (F.col(key.name).eqNullSafe(cut) & result)
        return result

    steps = F.array(*[F.lit(1 << b) for b in reversed(range(len(cuts).bit_length()))])
    whole = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when((at + step <= len(cuts)) & reached(at + step - 1), at + step).otherwise(at),
    )
    first = keys[0]
    if first.descending or any(cut[first.name] is None for cut in cuts):
        return whole
    # Beyond the last cut point there is nothing to compare with, which is as good as false.
    passed = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(F.col(first.name) > F.get(arrays[first.name], at + step - 1), at + step).otherwise(at),
    )
    return F.when(F.col(first.name).isNull(), whole).otherwise(
        F.transform(
            F.array(passed),
            lambda at: F.when(F.get(arrays[first.name], at) == F.col(first.name), whole).otherwise(at),
        )[0]
    )


@dataclass(frozen=True)
class _Dealt:
    """Rows shuffled by range, and for each range what comes before it."""

    rows: DataFrame
    counts: list[int]
    sums: list  # of the value, NULL where a range has none

    @property
    def total(self) -> int:
        return sum(self.counts)

    def rows_before(self) -> Column:
        before = [0, *accumulate(self.counts)][: len(self.counts)]
        return F.get(_literals(before, T.LongType()), F.col(_RANGE))

    def _running_sums(self) -> list:
        """What is added up before each range, and at last in all; NULL while there is nothing."""
        with localcontext(prec=80):  # decimals are added exactly
            return [None, *accumulate(self.sums, lambda x, y: x if y is None else y if x is None else x + y)]

    def sum_before(self, data_type: T.DataType) -> Column:
        return F.get(_literals(self._running_sums()[:-1], data_type), F.col(_RANGE))

    def sum_of_all(self, data_type: T.DataType) -> Column:
        return F.lit(self._running_sums()[-1]).cast(data_type)


@dataclass(frozen=True)
class _Numbered:
    """Rows with the number of their range, how the ranges are cut and what each holds."""

    rows: DataFrame
    keys: list[_Key]
    cuts: list[Row]
    counts: list[int]
    sums: list

    def deal(self, rows: DataFrame) -> _Dealt:
        """``rows`` are those of the ranges, perhaps with further columns."""
        return _Dealt(rows.repartitionById(len(self.counts), F.col(_RANGE)), self.counts, self.sums)


def _number(
    df: DataFrame, order: Sequence[Column], value: str | None = None, rows_per_range: int = ROWS_PER_RANGE
) -> _Numbered:
    keys = [_Key.of(column, df) for column in order]
    total = df.count()
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(partitions, ceil(total / MOST_PER_RANGE))
    ranges = min(wanted, MOST_RANGES, ceil(total / rows_per_range))
    cuts = _cut_points(df, order, keys, total, ranges)
    numbered = df.withColumn(_RANGE, _range_number(df, keys, cuts))
    measures = [F.count("*").alias("n")] + ([F.sum(value).alias("s")] if value else [])
    found = {r[_RANGE]: r for r in numbered.groupBy(_RANGE).agg(*measures).collect()}  # a row per range
    parts = range(len(cuts) + 1)
    counts = [found[i]["n"] if i in found else 0 for i in parts]
    sums = [found[i]["s"] if value and i in found else None for i in parts]
    return _Numbered(numbered, keys, cuts, counts, sums)


def _deal(
    df: DataFrame,
    order: Sequence[Column],
    workspace: Workspace | None,
    value: str | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> _Dealt:
    for column in order:
        _Key.of(column, df)
    if not reads_a_table(df):
        df = (workspace or Workspace(df.sparkSession)).materialize(df, "unordered")
    numbered = _number(df, order, value, rows_per_range)
    return numbered.deal(numbered.rows)


def global_rank(
    df: DataFrame,
    order: Sequence[Column],
    name: str = "row_rank",
    total: str | None = None,
    workspace: Workspace | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``row_number()`` over the whole input; ``total`` names a row-count column.

    ``order`` holds columns of the input with their directions and must end in columns that make it
    unique for a repeatable result.  Rows come in that order.
    """
    dealt = _deal(df, order, workspace, rows_per_range=rows_per_range)
    local = F.row_number().over(Window.partitionBy(_RANGE).orderBy(*order))
    extra = [F.lit(dealt.total).cast("long").alias(total)] if total else []
    return dealt.rows.select(*df.columns, (local + dealt.rows_before()).alias(name), *extra)


def ranked_lookup(
    df: DataFrame,
    order: Sequence[Column],
    name: str,
    table: DataFrame,
    key: str,
    attach: Callable[[DataFrame], DataFrame] | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``global_rank`` of ``df``, and an inner join of its first sort column with ``key``.

    ``df`` is a table, at most filtered or projected; the first sort column is ascending with
    NULL last, as rows without it have no match and rank after all others.  A row of ``table``
    goes to each range that holds rows of its key, so a hot key lies in many tasks.  The last
    sort column only tells equal rows apart: it spreads them and is not part of the result.
    ``attach`` adds columns to the rows before they are shuffled; it must keep each row once.
    """
    numbered = _number(df, order, rows_per_range=rows_per_range)
    first, spread = numbered.keys[0], numbered.keys[-1].name
    if first.descending or first.nulls_first:
        raise ValueError("the first sort column must be ascending with NULL last")
    rows = numbered.rows if attach is None else attach(numbered.rows)
    dealt = numbered.deal(rows.where(F.col(first.name).isNotNull()).drop(spread))
    within = Window.partitionBy(_RANGE).orderBy(F.col(first.name).asc(), *order[1:-1])
    ranked = dealt.rows.withColumn(name, F.row_number().over(within) + dealt.rows_before())

    keyed = table.where(F.col(key).isNotNull()).withColumn(key, F.col(key).cast(df.schema[first.name].dataType))
    places = [_Key(key, False, False)]
    cuts = [Row(**{key: cut[first.name]}) for cut in numbered.cuts]
    ranges = F.sequence(_range_number(keyed, places, cuts, inclusive=False), _range_number(keyed, places, cuts))
    copies = keyed.select("*", F.explode(ranges).alias("__copy")).repartitionById(
        len(numbered.counts), F.col("__copy")
    )
    same = [F.col(_RANGE) == F.col("__copy"), F.col(first.name) == F.col(key)]
    return ranked.join(copies.hint("merge"), same).drop(_RANGE, "__copy")


def global_cumulative(
    df: DataFrame,
    value: str,
    order: Sequence[Column],
    rank: str = "row_rank",
    running: str = "running_total",
    total: str = "grand_total",
    rows: str = "total_rows",
    workspace: Workspace | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Global rank, running sum of ``value`` in that order, and both totals; sorted by rank."""
    dealt = _deal(df, order, workspace, value, rows_per_range)
    type_of_sum = df.agg(F.sum(value).alias("s")).schema["s"].dataType
    within = Window.partitionBy(_RANGE).orderBy(*order)
    local = F.sum(value).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = dealt.sum_before(type_of_sum)
    return dealt.rows.select(
        *df.columns,
        (F.row_number().over(within) + dealt.rows_before()).alias(rank),
        F.coalesce(local + before, local, before).cast(type_of_sum).alias(running),
        dealt.sum_of_all(type_of_sum).alias(total),
        F.lit(dealt.total).cast("long").alias(rows),
    )


def ntile_from_rank(rank: Column, rows: Column, buckets: int) -> Column:
    """Bucket number of a row from its rank: the first buckets get the rest rows."""
    k = F.lit(buckets).cast("long")
    small = F.floor(rows / k).cast("long")
    large_rows = (rows % k) * (small + 1)
    in_large = F.floor((rank - 1) / (small + 1)) + 1
    in_small = (rows % k) + F.floor((rank - large_rows - 1) / F.greatest(small, F.lit(1))) + 1
    return F.when(rank <= large_rows, in_large).otherwise(in_small).cast("int")


def global_ntile(
    df: DataFrame,
    buckets: int,
    order: Sequence[Column],
    name: str = "bucket",
    workspace: Workspace | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``ntile(buckets)`` over the whole input."""
    ranked = global_rank(df, order, "__rank", "__rows_total", workspace, rows_per_range)
    bucket = ntile_from_rank(F.col("__rank"), F.col("__rows_total"), buckets)
    return ranked.select(*df.columns, bucket.alias(name))


def assign_dense_key(
    df: DataFrame,
    natural_key: Sequence[str],
    name: str,
    workspace: Workspace | None = None,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Surrogate keys 1..N in natural-key order: no gaps, same on every run."""
    order = [F.col(column).asc_nulls_last() for column in natural_key]
    keyed = global_rank(df, order, name, workspace=workspace, rows_per_range=rows_per_range)
    return keyed.select(name, *df.columns)


def top_k_share(df: DataFrame, value: str, k: int, order: Sequence[Column], name: str) -> DataFrame:
    """One row: percentage of the sum of ``value`` held by the first ``k`` rows."""
    from cargolens.functions.numbers import ratio_pct

    top = df.orderBy(*order).limit(k).agg(F.sum(value).alias("top"))
    whole = df.agg(F.sum(value).alias("whole"))
    return whole.select(ratio_pct(top.scalar(), F.col("whole")).alias(name))
