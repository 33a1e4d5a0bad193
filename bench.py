"""Time the layer builds and the headline queries; prints one JSON line.

BENCH_SF_DIR   folder of sales tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated name prefixes (default: the analyses and the
               operators that order or scan every item)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from cargolens.registry import queries as registry  # noqa: E402

DEFAULT = "a,p06,p07,p08,b02_grain,b07_null_profile_all,b09_constant,b21_fd,b28_numeric,s_clean,g08,c16_star_view,c18_release"


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    prefixes = tuple(os.environ.get("BENCH_QUERIES", DEFAULT).split(","))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cargolens-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        # Small local files: let every core have a split.
        .config("spark.sql.files.openCostInBytes", "1m")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}

    def timed(name: str, action) -> None:
        start = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - start, 3)

    timed("build_bronze", lambda: registry.bronze(spark, folder))
    timed("build_silver", lambda: registry.silver(spark, folder))
    timed("build_gold", lambda: registry.star(spark, folder))
    for name, query in registry.queries().items():
        if name.startswith(prefixes) and not name.endswith("_exact"):
            timed(name, lambda: query(spark, folder).write.format("noop").mode("overwrite").save())

    items = registry.star(spark, folder).fact.count()
    print(json.dumps({
        "metric": "warehouse build and headline queries, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "order_items": items,
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
