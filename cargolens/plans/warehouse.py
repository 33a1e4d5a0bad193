"""Building the layers: bronze once, silver and gold as full refreshes."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from cargolens import schemas as S
from cargolens.operators import checks
from cargolens.plans import quality, star as model
from cargolens.plans.silver import SILVER, clean
from cargolens.sources.layers import Layer, wide_rows
from cargolens.workspace import Workspace

RAW, CLEAN, FACT, DATE = "order_items_raw", "order_items_clean", "fact_order_item", "dim_date"


class Warehouse:
    """Three layers of Parquet tables below one shared folder."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.workspace = Workspace(spark, root)
        root = self.workspace.root
        self.bronze_layer, self.silver_layer = Layer(spark, root, "bronze"), Layer(spark, root, "silver")
        self.gold_layer = Layer(spark, root, "gold", measured=True)  # lookups go by these sizes

    @property
    def bronze(self) -> DataFrame:
        return self.bronze_layer.read(RAW, S.BRONZE)

    @property
    def silver(self) -> DataFrame:
        return self.silver_layer.read(CLEAN, SILVER)

    @property
    def star(self) -> model.Star:
        return model.Star(
            self.gold_layer.read(FACT, S.FACT),
            *[self.gold_layer.read(spec.table, spec.schema) for spec in model.DIMENSIONS],
            self.gold_layer.read(DATE, S.CALENDAR),
            self.workspace,
        )

    def load_bronze(self, raw: DataFrame) -> DataFrame:
        """Import raw text rows; a second import into the table fails."""
        return self.bronze_layer.load_once(raw, RAW, S.BRONZE)

    def build_silver(self) -> DataFrame:
        """Clean every raw row; a table that breaks a constraint is not published."""
        with self.silver_layer.replaced():
            with wide_rows(self.workspace.spark):
                silver = self.silver_layer.refresh(clean(self.bronze), CLEAN, SILVER)
            checks.enforce(quality.silver_violations(silver), CLEAN)
        return self.silver

    def build_gold(self) -> model.Star:
        """Dimensions, then the fact; all are published together once every check passed."""
        silver = self.silver
        build = Workspace(self.workspace.spark, f"{self.workspace.root}/build")

        def dimension(spec: model.Dimension) -> DataFrame:
            rows = model.build_dimension(silver, spec, build)
            return self.gold_layer.refresh(rows, spec.table, spec.schema)

        with self.gold_layer.replaced():
            # Independent jobs: submitted together, the cluster interleaves them.
            with ThreadPoolExecutor(len(model.DIMENSIONS) + 1) as pool:
                calendar = pool.submit(
                    lambda: self.gold_layer.refresh(model.build_calendar(silver), DATE, S.CALENDAR)
                )
                written = list(pool.map(dimension, model.DIMENSIONS))
                date = calendar.result()
            checks.enforce(quality.model_violations(list(zip(model.DIMENSIONS, written)), date), "gold")

            fact = model.build_fact(silver, *written)
            # Sorted files keep the date statistics of their row groups narrow.
            fact = fact.sortWithinPartitions("order_date_key")
            loaded = self.gold_layer.refresh(fact, FACT, S.FACT)
            # Uniqueness of the fact is one of the release conditions.
            checks.enforce(quality.fact_nulls(loaded), FACT)
            checks.release(quality.release_checks(silver, model.Star(loaded, *written, date, self.workspace)))
        build.discard()
        return self.star

    def register_views(self) -> list[str]:
        """Temporary views such as ``gold_dim_date`` for SQL users."""
        tables = [
            (self.bronze_layer, RAW, S.BRONZE),
            (self.silver_layer, CLEAN, SILVER),
            (self.gold_layer, FACT, S.FACT),
            (self.gold_layer, DATE, S.CALENDAR),
            *[(self.gold_layer, spec.table, spec.schema) for spec in model.DIMENSIONS],
        ]
        return [layer.register_view(table, schema) for layer, table, schema in tables]
