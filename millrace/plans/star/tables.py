"""The 24-table retail star that the reports read.

``Star.derived`` builds it lazily from the raw order tables; ``Star.stored``
reads one Parquet directory per table, for users who already hold a star.
Every table is an unmaterialised DataFrame, so each report scans only the
columns and rows it needs.
"""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.plans.star import derive

TABLES = (
    "store_sales", "store_returns", "catalog_sales", "catalog_returns", "web_sales",
    "web_returns", "inventory", "date_dim", "time_dim", "item", "store", "customer",
    "customer_address", "customer_demographics", "household_demographics", "income_band",
    "warehouse", "web_site", "web_page", "catalog_page", "call_center", "ship_mode",
    "reason", "promotion",
)


class Star:
    """Tables by attribute: ``star.store_sales``, ``star.date_dim`` ..."""

    def __init__(self, spark: SparkSession, load: Callable[[str], DataFrame]):
        self.spark = spark
        self._load = load
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.table(name)

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._load(name)
        return self._frames[name]

    @classmethod
    def stored(cls, spark: SparkSession, path: str) -> "Star":
        return cls(spark, lambda name: spark.read.parquet(f"{path}/{name}"))

    @classmethod
    def bucketed(cls, spark: SparkSession, prefix: str, names: tuple[str, ...] = TABLES, rest: "Star | None" = None) -> "Star":
        """Tables of the catalog as ``save_bucketed_star`` names them; those not among ``names`` are taken from ``rest``.

        A join on order, item and one more key also goes without a shuffle of
        tables that are bucketed by order and item.
        """
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        return cls(spark, lambda name: spark.table(prefix + name) if rest is None or name in names else rest.table(name))

    @classmethod
    def derived(cls, spark: SparkSession, sf_dir: str) -> "Star":
        sql = derive.statements(derive.SPARK)
        built: dict[str, DataFrame] = {}

        def build(name: str) -> DataFrame:
            if name not in built:
                if name in sql:
                    used = {f for _, f, _, _ in string.Formatter().parse(sql[name]) if f}
                    built[name] = spark.sql(sql[name], **{u: build(u) for u in used})
                else:
                    built[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
            return built[name]

        return cls(spark, lambda name: build("customers" if name == "customer" else name))
