"""What several operators of this subpackage need."""

from __future__ import annotations

import ctypes
import itertools
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cargolens.workspace import Workspace, delete_folder

ROW_BITS = 33  # monotonically_increasing_id: task above, row in the task below


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have (case does not count)."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        tries = (f"{name}{'_' * k}" for k in itertools.count())
        found.append(next(t for t in tries if t.lower() not in taken))
        taken.add(found[-1].lower())
    return found


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` evaluated once however often it is used."""
    return F.transform(F.array(value), body)[0]


def give_back_memory() -> None:
    """Return free memory of this process to the system.

    Python workers outlive their task, and an idle one would keep what its task needed at most.
    """
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of glibc alone
        trim(0)


def small_batches(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows, ``rows`` at most at a time; free memory is given back behind the last.

    What a worker makes of a batch, as Python objects and as its answer, is then bounded by
    these rows and not by those that Spark sends at once.  Nothing is copied.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
    give_back_memory()


# Shuffle files of a query are deleted when it ends, and not when the driver's memory
# happens to be collected.
_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Intermediate tables in the shared folder; each is written once and can be dropped.

    A written table needs its shuffle files no more, so they go with the write; what
    several steps leave on the disks is then their tables.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._workspace = Workspace(spark)
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = self._workspace.fresh_path(name)
        before = self.spark.conf.get(_RELEASE, None)
        self.spark.conf.set(_RELEASE, "true")
        try:
            df.write.parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(_RELEASE)
            else:
                self.spark.conf.set(_RELEASE, before)
        written = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(written)] = written, path  # the table is kept, so its id stays its own
        return written

    def drop(self, *tables: DataFrame) -> None:
        """Delete written tables that nothing refers to any more."""
        for table in tables:
            if kept := self._paths.pop(id(table), None):
                delete_folder(self.spark, kept[1])


def dense_slots(
    df: DataFrame, group: str, order: Sequence[str], scratch: Scratch, name: str
) -> DataFrame:
    """Add the gapless position (from 0) of each row among the rows of its group.

    One range sort on (group, order) spreads a group of any size over many tasks;
    the sorted rows are written once.  A group's rows in one task are consecutive,
    so a position is the place in the task plus what earlier tasks hold.  The
    table of those offsets has at most one row per task and per group (both
    bounded by settings, not by the data), so it is broadcast.
    ``group`` must not hold nulls.
    """
    at, task, first, base = unused(df, "at", "task", "first", "base")
    ordered = df.orderBy(group, *order).withColumn(at, F.monotonically_increasing_id())
    placed = scratch.table(ordered, "slots").withColumn(task, F.shiftright(at, ROW_BITS))
    runs = placed.groupBy(group, task).agg(F.min(at).alias(first), F.count("*").alias("n"))
    earlier = Window.partitionBy(group).orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        group, task, first, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(base)
    )
    return (
        placed.join(F.broadcast(offsets), [group, task])
        .withColumn(name, (F.col(base) + F.col(at) - F.col(first)).cast("long"))
        .select(*df.columns, name)
    )
