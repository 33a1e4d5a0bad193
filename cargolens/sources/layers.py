"""Layer tables as Parquet folders."""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from cargolens.operators.joins import ROWS, WIDTH
from cargolens.workspace import WRITE_OPTIONS, delete_folder

# Some fifty cleaned columns compile into one method longer than the JVM
# optimises; above this size Spark falls back to several smaller methods.
_WIDE_ROWS = ("spark.sql.codegen.hugeMethodLimit", "8000")
_NUMBER_BYTES = 8  # of a value that is no text, in a row in memory


class RefreshConflict(RuntimeError):
    """Another refresh was published since this one began; this one is not."""


@contextmanager
def wide_rows(spark: SparkSession):
    """Session setting for writing wide tables, restored afterwards."""
    name, value = _WIDE_ROWS
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class Layer:
    """One namespace of tables below a root folder.

    An import writes its table once.  A refresh replaces the layer's tables together:
    they go to a folder of their own, and readers see the version published before until
    every check has passed and the new one is published.  Versions are numbered; the
    marker of the next number is created only if there is none, so of several refreshes
    that start from one version the first to finish is published and the others fail.  A
    failed refresh leaves no trace.  The version before the published one stays, for
    readers that are still at it.

    A ``measured`` layer keeps the rows and the mean width in memory of each table, found
    while it is written, and says so in the columns of what it reads.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, measured: bool = False):
        self.spark, self.name, self.measured = spark, name, measured
        self.folder = f"{root.rstrip('/')}/{name}"
        self._next: str | None = None

    def _path(self, folder: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _create(self, file: str, text: str) -> None:
        """Write a small file that must not exist yet."""
        system, path = self._path(file)
        out = system.create(path, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def _text(self, file: str) -> str | None:
        system, path = self._path(file)
        if not system.exists(path):
            return None
        source = system.open(path)
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def _markers(self) -> list[str]:
        system, path = self._path(f"{self.folder}/_published")
        if not system.exists(path):
            return []
        return sorted(f.getPath().getName() for f in system.listStatus(path))

    def versions(self) -> list[str]:
        """Folders of the published versions, the current one last."""
        return [self._text(f"{self.folder}/_published/{marker}") for marker in self._markers()]

    def path(self, table: str) -> str:
        marker = self._markers()[-1:]
        current = [self._text(f"{self.folder}/_published/{m}") for m in marker]
        return "/".join([self.folder, *current, table])

    def _at(self, path: str, schema: T.StructType) -> DataFrame:
        folder, _, table = path.rpartition("/")
        sizes = json.loads(self._text(f"{folder}/_sizes/{table}.json") or "{}") if self.measured else {}
        fields = [
            T.StructField(
                f.name, f.dataType, f.nullable,
                {ROWS: sizes["rows"], WIDTH: sizes["widths"][f.name]} if sizes else None,
            )
            for f in schema.fields
        ]
        return self.spark.read.schema(T.StructType(fields)).parquet(path)

    def read(self, table: str, schema: T.StructType) -> DataFrame:
        return self._at(self.path(table), schema)

    def _write(self, df: DataFrame, path: str) -> None:
        if not self.measured:
            df.write.options(**WRITE_OPTIONS).parquet(path)
            return
        text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        seen = Observation()
        lengths = [F.sum(F.octet_length(name)).alias(f"length_{name}") for name in text]
        df.observe(seen, F.count(F.lit(1)).alias("rows"), *lengths).write.options(**WRITE_OPTIONS).parquet(path)
        rows = seen.get["rows"]
        widths = {
            name: _NUMBER_BYTES if name not in text
            else (seen.get[f"length_{name}"] or 0) / max(rows, 1)
            for name in df.columns
        }
        folder, _, table = path.rpartition("/")
        self._create(f"{folder}/_sizes/{table}.json", json.dumps({"rows": rows, "widths": widths}))

    def load_once(self, df: DataFrame, table: str, schema: T.StructType) -> DataFrame:
        """Fail if the table is already filled: an import must not be repeated."""
        with wide_rows(self.spark):
            self._write(df.select(*schema.names), self.path(table))
        return self.read(table, schema)

    @contextmanager
    def replaced(self):
        """Tables refreshed inside are published together at the end, or not at all."""
        markers = self._markers()
        number = int(markers[-1]) + 1 if markers else 1
        self._next = f"v{number:010d}-{uuid.uuid4().hex[:8]}"
        try:
            yield
            try:
                self._create(f"{self.folder}/_published/{number:010d}", self._next)
            except Exception as error:
                if self._text(f"{self.folder}/_published/{number:010d}") is None:
                    raise
                raise RefreshConflict(f"{self.name}: version {number} was published meanwhile") from error
        except BaseException:
            delete_folder(self.spark, f"{self.folder}/{self._next}")
            raise
        finally:
            self._next = None
        for marker in self._markers()[:-2]:
            delete_folder(self.spark, f"{self.folder}/{self._text(f'{self.folder}/_published/{marker}')}")
            delete_folder(self.spark, f"{self.folder}/_published/{marker}")

    def refresh(self, df: DataFrame, table: str, schema: T.StructType) -> DataFrame:
        """Write exactly the target columns in order into the version in the making."""
        if not self._next:
            raise ValueError("a table is refreshed inside replaced()")
        found = {field.name: field.dataType for field in df.schema.fields}
        for field in schema.fields:
            if found[field.name] != field.dataType:
                raise TypeError(f"{table}.{field.name}: {found[field.name]} is not {field.dataType}")
        path = f"{self.folder}/{self._next}/{table}"
        self._write(df.select(*schema.names), path)
        return self._at(path, schema)

    def register_view(self, table: str, schema: T.StructType) -> str:
        """A temporary view named after layer and table, e.g. ``gold_dim_date``."""
        view = f"{self.name}_{table}"
        self.read(table, schema).createOrReplaceTempView(view)
        return view
