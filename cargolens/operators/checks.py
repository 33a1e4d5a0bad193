"""Data-quality checks: each returns rows, ``enforce`` turns them into failures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cargolens.operators.profiling import duplicate_keys


class ConstraintViolation(ValueError):
    """Data broke a declared constraint; nothing was released."""


def _violation(df: DataFrame, constraint: str, column: str, count) -> DataFrame:
    return df.agg(count.cast("long").alias("violations")).select(
        F.lit(constraint).alias("constraint_name"), F.lit(column).alias("column_name"), "violations"
    )


def check_unique(df: DataFrame, *key: str) -> DataFrame:
    """Number of key values that occur more than once (NULL is no value)."""
    present = df
    for column in key:
        present = present.where(F.col(column).isNotNull())
    return _violation(duplicate_keys(present, *key), "unique", ",".join(key), F.count("*"))


def _per_column(df: DataFrame, constraint: str, tests: Mapping[str, object]) -> DataFrame:
    """One pass over the table, one output row per tested column."""
    counts = [F.count_if(test).alias(f"c{i}") for i, test in enumerate(tests.values())]
    rows = [
        F.struct(
            F.lit(constraint).alias("constraint_name"),
            F.lit(column).alias("column_name"),
            F.col(f"c{i}").alias("violations"),
        )
        for i, column in enumerate(tests)
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def check_not_null(df: DataFrame, *columns: str) -> DataFrame:
    return _per_column(df, "not_null", {name: F.col(name).isNull() for name in columns})


def check_max_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    return _per_column(
        df, "max_length", {name: F.char_length(name) > limit for name, limit in limits.items()}
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def enforce(violations: DataFrame, table: str) -> None:
    """Raise if any check counted a violation (one small row per check)."""
    broken = violations.where(F.col("violations") > 0).collect()
    if broken:
        found = "; ".join(
            f"{row.asDict().get('table_name', table)}: "
            f"{row['constraint_name']}({row['column_name']}): {row['violations']}"
            for row in broken
        )
        raise ConstraintViolation(found)


def expectations(df: DataFrame, tests: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """A row (check, expected, actual, passed) for each test of one one-row result."""
    rows = [
        F.struct(
            F.lit(check).alias("check_name"),
            expected.cast("long").alias("expected"),
            actual.cast("long").alias("actual"),
        )
        for check, (expected, actual) in tests.items()
    ]
    return df.select(F.inline(F.array(*rows))).withColumn("passed", F.equal_null("expected", "actual"))


def release(checks: DataFrame) -> None:
    """Fail unless every expectation holds."""
    failed = checks.where(~F.col("passed")).collect()
    if failed:
        found = "; ".join(
            f"{row['check_name']}: expected {row['expected']}, found {row['actual']}" for row in failed
        )
        raise ConstraintViolation(f"release blocked: {found}")
