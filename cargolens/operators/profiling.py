"""Profiling of raw text tables.  Each profiler is one distributed aggregate."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Row, functions as F

from cargolens.functions import exact
from cargolens.functions.numbers import ratio_pct
from cargolens.functions.parsing import numeric, us_timestamp
from cargolens.functions.text import concat_skip_nulls, has_outer_spaces

MEAN_PLACES = 6


# Columns of a table that are aggregated together.  A column file is read once whatever
# the group, and the generated code of so few stays small enough for the JVM to compile.
_TOGETHER = 10


def _in_groups(columns: Sequence[str], build: Callable[[Sequence[str]], DataFrame]) -> DataFrame:
    groups = [columns[i : i + _TOGETHER] for i in range(0, len(columns), _TOGETHER)]
    return reduce(DataFrame.unionByName, map(build, groups))


def _by_column(df: DataFrame, columns: Sequence[str], measures) -> DataFrame:
    """Aggregate these columns in one pass, then give each its own row.

    ``measures(name)`` maps output names to aggregates of one column.
    """
    aggregates, rows = [], []
    for index, name in enumerate(columns):
        fields = [F.lit(name).alias("column_name")]
        for label, aggregate in measures(name).items():
            aggregates.append(aggregate.alias(f"{label}_{index}"))
            fields.append(F.col(f"{label}_{index}").alias(label))
        rows.append(F.struct(*fields))
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def row_count(df: DataFrame, name: str = "total_rows") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def key_grain(df: DataFrame, key: str, distinct: str, total: str | None = None) -> DataFrame:
    """Exact number of distinct keys, beside the row count if ``total`` is given."""
    measures = [F.count("*").alias(total)] if total else []
    return df.agg(*measures, F.count_distinct(key).alias(distinct))


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    counted = df.groupBy(*key).agg(F.count("*").alias("duplicate_count"))
    return counted.where(F.col("duplicate_count") > 1)


def column_mismatch(df: DataFrame, left: Column, right: Column, name: str) -> DataFrame:
    """Rows whose two columns differ; a NULL on either side is no difference."""
    return df.agg(F.count_if(left != right).alias(name))


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL counts of many columns, each read once, one output row per column."""
    return _in_groups(columns, lambda group: _null_profile(df, group))


def _null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = df.agg(
        F.count("*").alias("total_rows"),
        *[F.count(name).alias(f"present_{i}") for i, name in enumerate(columns)],
    )
    total = F.col("total_rows")
    rows = []
    for i, name in enumerate(columns):
        present = F.col(f"present_{i}")
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                total.alias("total_rows"),
                present.alias("non_null_rows"),
                (total - present).alias("null_rows"),
                ratio_pct(total - present, total).alias("null_percentage"),
            )
        )
    return counts.select(F.inline(F.array(*rows)))


def constant_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Whether a column holds at most one value, from its minimum and maximum."""

    def measures(name: str) -> Mapping[str, Column]:
        return {
            "lowest_value": F.min(name),
            "highest_value": F.max(name),
            "is_constant": F.coalesce(F.min(name) == F.max(name), F.lit(True)),
        }

    return _in_groups(columns, lambda group: _by_column(df, group, measures))


def value_frequency(df: DataFrame, column: str, by_value: bool = False) -> DataFrame:
    counted = df.groupBy(column).agg(F.count("*").alias("row_count"))
    value = F.col(column).asc_nulls_last()
    return counted.orderBy(value) if by_value else counted.orderBy(F.desc("row_count"), value)


def _first_values(values: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` distinct values of each task, in order, NULL last."""
    names = values.columns

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            found = batch.column(0) if kept is None else pa.concat_arrays([kept, batch.column(0)])
            found = pc.unique(found)
            kept = found.take(pc.array_sort_indices(found)[:limit])
        if kept is not None:
            yield pa.record_batch([kept], names)

    return values.mapInArrow(first, values.schema)


def distinct_sample(df: DataFrame, column: str, limit: int = 20) -> DataFrame:
    """The first ``limit`` distinct values in order, NULL last.

    Every task keeps its own first ones while it reads, so no more than ``limit`` rows of
    a task are shuffled, however many values there are and however often each occurs.
    """
    in_tasks = _first_values(df.select(column), limit)
    return in_tasks.distinct().orderBy(F.col(column).asc_nulls_last()).limit(limit)


def distinct_sketches(df: DataFrame, columns: Sequence[str], *by: str, lg_nodes: int = 14) -> DataFrame:
    """A sketch of the distinct values of each column, in one scan; see ``sketched_counts``.

    Exact counts shuffle every distinct value.  A sketch has at most 2 ** ``lg_nodes``
    bytes, whatever the column, and sketches of parts (``by``) merge into those of the whole.
    """
    sketches = [F.hll_sketch_agg(name, lg_nodes).alias(name) for name in columns]
    return df.groupBy(*by).agg(*sketches)


def sketched_counts(sketches: DataFrame, columns: Sequence[str], lg_nodes: int = 14) -> DataFrame:
    """column_name, distinct_values and their relative standard error, of merged sketches.

    Two estimates in three are within one standard error, 99.7 of a hundred within three.
    """
    error = 1.04 / 2 ** (lg_nodes / 2)

    def measures(name: str) -> Mapping[str, Column]:
        estimate = F.hll_sketch_estimate(F.hll_union_agg(name))
        return {"distinct_values": F.coalesce(estimate, F.lit(0))}

    return _by_column(sketches, columns, measures).withColumn("standard_error", F.lit(error))


def populated_rows(df: DataFrame, column: str, name: str) -> DataFrame:
    """Presence count that never shows a value."""
    return df.agg(F.count(column).alias(name))


def functional_dependency(
    df: DataFrame, key: str | Sequence[str], dependents: Sequence[str], name: str
) -> DataFrame:
    """Keys that occur with more than one version of the dependent columns.

    One dependent ignores NULLs; several are compared as one joined text in
    which NULL reads as empty.
    """
    if len(dependents) == 1:
        version = F.col(dependents[0])
    else:
        parts = [part for column in dependents for part in (F.lit("|"), F.col(column))]
        version = concat_skip_nulls(*parts[1:])
    keys = [key] if isinstance(key, str) else list(key)
    versions = df.groupBy(*keys).agg(F.count_distinct(version).alias(name))
    return versions.where(F.col(name) > 1)


def inconsistent_keys(df: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """Per attribute, how many keys hold more than one version of it.

    A key varies when its minimum and maximum differ or only some of its rows
    are NULL, so all attributes fit in one grouping without distinct counts.
    Equal rows are dropped first, within each task before anything is shuffled.
    """
    per_key = df.select(key, *attributes).distinct().groupBy(key).agg(
        *[
            (
                F.coalesce(F.min(name) != F.max(name), F.lit(False))
                | ((F.count(name) > 0) & (F.count(name) < F.count("*")))
            ).alias(name)
            for name in attributes
        ]
    )
    return _by_column(
        per_key, attributes, lambda name: {"varying_keys": F.count_if(F.col(name))}
    )


def numeric_range(
    df: DataFrame, column: str, lowest: str, highest: str, mean: str | None = None, places: int = MEAN_PLACES
) -> DataFrame:
    """Minimum, maximum and mean of a text column of numbers, as exact text."""
    names = {"lowest": lowest, "highest": highest} | ({"mean": mean} if mean else {})
    found = numeric_profile(df, [column], places)
    return found.select(*[F.col(part).alias(name) for part, name in names.items()])


def numeric_profile(df: DataFrame, columns: Sequence[str], places: int = MEAN_PLACES) -> DataFrame:
    """Ranges of many columns, each read once, one output row per column.

    Minimum and maximum keep every digit; the mean is rounded to ``places`` once.  Columns
    with numbers too long for a decimal are read once more.
    """

    def totals(names: Sequence[str], measures) -> dict[str, Row]:
        found = _in_groups(names, lambda group: _by_column(df, group, measures)) if names else None
        return {row["column_name"]: row for row in found.collect()} if found is not None else {}

    ordinary = totals(columns, exact.ordinary_totals)
    long = totals([name for name in columns if ordinary[name]["others"]], exact.long_totals)
    rows = [(name, *exact.summary(ordinary[name], long.get(name), places)) for name in columns]
    return df.sparkSession.createDataFrame(rows, "column_name string, lowest string, highest string, mean string")


def predicate_counts(df: DataFrame, **predicates: Column) -> DataFrame:
    """Rows matching each named predicate, all in one pass."""
    return df.agg(*[F.count_if(test).alias(name) for name, test in predicates.items()])


def row_sample(df: DataFrame, columns: Sequence[str], order: Sequence[Column], limit: int) -> DataFrame:
    """The first ``limit`` rows in ``order`` (a distributed top-k, no full sort)."""
    return df.orderBy(*order).limit(limit).select(*columns)


def timestamp_range(df: DataFrame, column: str, earliest: str, latest: str) -> DataFrame:
    """Parsed before comparing, so the order is chronological."""
    moment = us_timestamp(column)
    return df.agg(F.min(moment).alias(earliest), F.max(moment).alias(latest))


def whitespace(df: DataFrame, **columns: str) -> DataFrame:
    """Rows whose text has outer spaces, one count per named column."""
    return predicate_counts(
        df, **{name: has_outer_spaces(F.col(column)) for name, column in columns.items()}
    )
