"""Expiring copies of tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.sinks import folders
from millrace.sinks.archive import duplicates

SUFFIX = "_snapshot"
MANIFEST = "dataset string, table string, path string, created_at timestamp, expires_at timestamp"


def take_snapshot(df: DataFrame, root: str, dataset: str, table: str, now: dt.datetime, keep_days: int = 7) -> str | None:
    """Copy to ``<dataset>_snapshot/<table>_<day>``; refuses to overwrite.

    Datasets that hold snapshots are skipped.
    """
    if dataset.endswith(SUFFIX):
        return None
    spark = df.sparkSession
    path = f"{root}/{dataset}{SUFFIX}/{table}_{now:%Y%m%d}"
    if folders.exists(spark, path):
        raise ValueError(f"{path} already exists")
    df.write.mode("errorifexists").parquet(path)
    row = (dataset + SUFFIX, table, path, now, now + dt.timedelta(days=keep_days))
    spark.createDataFrame([row], MANIFEST).write.mode("append").parquet(f"{root}/_manifest")
    return path


def take_snapshots(plan: DataFrame, tables, root: str, now: dt.datetime, keep_days: int = 7) -> list[str]:
    """Copies of the tables of an expanded plan; nothing is copied if it names a table more than once.

    ``tables`` gives the rows of a dataset and table.
    """
    twice = [f"{r['input_dataset']}.{r['input_table']}" for r in duplicates(plan).limit(10).collect()]
    if twice:
        raise ValueError(f"named more than once: {', '.join(sorted(twice))}")
    named = plan.where("kind <> 'view'").select("input_dataset", "input_table").collect()  # metadata, a row per table
    taken = [take_snapshot(tables(*r), root, *r, now, keep_days) for r in sorted(named)]
    return [path for path in taken if path]


def snapshots(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{root}/_manifest")


def expire_snapshots(spark: SparkSession, root: str, now: dt.datetime) -> list[str]:
    """Remove the copies that are past their time; the manifest keeps their rows."""
    due = snapshots(spark, root).where(F.col("expires_at") <= F.lit(now)).select("path").collect()
    return sorted(r["path"] for r in due if folders.exists(spark, r["path"]) and folders.remove(spark, r["path"]))
