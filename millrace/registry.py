"""Named queries over the raw tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[..., DataFrame]] = {}


class Tables:
    """Raw tables of one folder by attribute; ``events.ts`` is an instant in UTC."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._frames:
            df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            self._frames[name] = df.withColumn("ts", df["ts"].cast("timestamp")) if name == "events" else df
        return self._frames[name]


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn
