"""Where intermediate and layer tables live.

Lineage is cut by writing Parquet to the folder the cluster shares
(``spark.checkpoint.dir``), never to executor-local storage, so a lost
executor costs a task retry and not a recomputation.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, types as T

CODEC = "zstd"  # of written tables: a third less than the default, for little time
# Dictionaries of all columns of a wide table stay in a core's cache; those of the default
# megabyte don't, and looking values up in them took a quarter of the time of a write.
WRITE_OPTIONS = {"compression": CODEC, "parquet.dictionary.page.size": str(64 << 10)}

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="cargolens-")
    return _local_roots[app]


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder on whatever file system it is on, if it exists."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def reads_a_table(df: DataFrame) -> bool:
    """Whether ``df`` is a table, at most filtered or projected, and so cheap to read again."""
    node = df._jdf.queryExecution().optimizedPlan()
    while node.nodeName() in ("Project", "Filter"):
        node = node.children().head()
    return node.children().isEmpty()


class Workspace:
    """A folder below the shared root that belongs to one application."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        app = spark.sparkContext.applicationId
        self.root = (root or f"{shared_root(spark)}/cargolens-{app}").rstrip("/")

    def fresh_path(self, name: str) -> str:
        return f"{self.root}/staging/{name}-{uuid.uuid4().hex}"

    def materialize(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` once and return the written table."""
        path = self.fresh_path(name)
        df.write.options(**WRITE_OPTIONS).parquet(path)
        # What columns say of the table they come from doesn't hold for this one.
        plain = T.StructType([T.StructField(f.name, f.dataType, f.nullable) for f in df.schema.fields])
        return self.spark.read.schema(plain).parquet(path)

    def discard(self) -> None:
        """Delete this workspace's staged tables once nothing refers to them."""
        delete_folder(self.spark, f"{self.root}/staging")
