"""Export jobs: aged partitions, query results and sharded tables to dated folders."""

from __future__ import annotations

import datetime as dt
from functools import reduce
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.operators.relational import union_all
from millrace.sinks import folders


def write_partitioned(df: DataFrame, key: str, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """One folder per key value; a very large value is spread over several files."""
    (df.hint("rebalance", key).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(key)
     .format(fmt).save(path))


def export_partitions(df: DataFrame, day: Column, path: str, today: dt.date, days: int, fmt: str = "parquet") -> None:
    """Rows whose day is at least ``days`` old, to ``path/dt=YYYY-MM-DD``."""
    aged = df.withColumn("dt", day.cast("date")).where(F.col("dt") <= F.lit(today - dt.timedelta(days=days)))
    write_partitioned(aged, "dt", path, fmt=fmt)


def export_select(spark: SparkSession, select: str, path: str, today: dt.date, fmt: str = "parquet") -> None:
    """The result of a query, to the folder of the day it ran."""
    write_partitioned(spark.sql(select).withColumn("dt", F.lit(today)), "dt", path, fmt=fmt)


def shard_suffix(table: str, prefix: str) -> str:
    """``YYYYMMDD`` endings become dates, other endings stay as they are."""
    ending = table[len(prefix):].lstrip("_")
    if re.fullmatch(r"[0-9]{8}", ending):
        return f"{ending[:4]}-{ending[4:6]}-{ending[6:]}"
    return ending


def export_shards(spark: SparkSession, tables: list[str], prefix: str, path: str, fmt: str = "parquet") -> None:
    """Named shards of one table to a folder per suffix, in one job."""
    missing = [name for name in tables if not spark.catalog.tableExists(name)]
    if missing:
        raise ValueError(f"no such table: {', '.join(missing)}")
    shards = [spark.table(name).withColumn("suffix", F.lit(shard_suffix(name, prefix))) for name in tables]
    write_partitioned(union_all(*shards), "suffix", path, fmt=fmt)


def daily_shards(names: list[str], prefix: str, before: dt.date | None = None) -> list[str]:
    """Names made of the prefix and eight digits, optionally only days up to ``before``."""
    pattern = re.compile(rf"{re.escape(prefix)}([0-9]{{8}})", re.IGNORECASE)
    found = [(name, pattern.fullmatch(name)) for name in names]
    last = None if before is None else f"{before:%Y%m%d}"
    return sorted(name for name, m in found if m and (last is None or m.group(1) <= last))


def external_table(spark: SparkSession, path: str, partition: str | None = None) -> DataFrame:
    """Hive-partitioned folder as a table; ``partition`` declares the key, else it is inferred."""
    df = spark.read.parquet(path)
    if partition is None:
        return df
    name = partition.split()[0]
    declared = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name != name)
    return spark.read.schema(f"{declared}, {partition}").parquet(path)


def partition_filters(df: DataFrame) -> list[str]:
    """Partition conditions of every scan in the physical plan of a query."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", plan)


def require_partition_filter(df: DataFrame, key: str) -> DataFrame:
    """Reject a query that would scan every partition of a table keyed by ``key``."""
    # a test for null excludes no partition
    scans = [re.sub(r"isnotnull\([^()]*\)", "", s) for s in partition_filters(df)]
    if not scans or any(f"{key}#" not in s for s in scans):
        raise ValueError(f"the query needs a filter on the partition column {key}")
    return df


def aged_partitions(spark: SparkSession, path: str, today: dt.date, days: int, key: str = "dt") -> list[str]:
    """Partition folders more than ``days`` days old."""
    limit = today - dt.timedelta(days=days)
    found = [c for c in folders.children(spark, path) if c.startswith(key + "=")]
    return [c for c in found if dt.date.fromisoformat(c[len(key) + 1:]) < limit]


def drop_aged_partitions(spark: SparkSession, path: str, today: dt.date, days: int = 90, key: str = "dt") -> list[str]:
    """Retention: remove the folders of partitions past their age."""
    gone = aged_partitions(spark, path, today, days, key)
    for name in gone:
        folders.remove(spark, f"{path}/{name}")
    return gone


# ---- planning --------------------------------------------------------------

def table_kind(df: DataFrame) -> DataFrame:
    """Kind of a table from its metadata: table_type, range_partitioning, partitioning_type."""
    physical = (F.when(F.col("range_partitioning").isNotNull(), "int_partition")
                .when(F.col("partitioning_type").isNotNull(), "time_partition").otherwise("no_partition"))
    return df.withColumn("kind", F.when(F.col("table_type") == "TABLE", physical).otherwise("view"))


def expanded(config: DataFrame, catalog: DataFrame) -> DataFrame:
    """One row per table of a configuration with ``*`` datasets or tables.

    Names with a day marker or an inner ``*`` stand for shards and pass through.
    """
    day = F.col("input_table").contains("{YYYYMMDD}")
    some = F.col("input_table").contains("*") & (F.col("input_table") != "*") & (F.col("input_dataset") != "*")
    shard = F.when(day, "shard_table_day").when(some, "shard_table")
    shards = config.where(day | some).withColumn("kind", shard)
    named = config.where(~(day | some)).withColumnsRenamed({"input_dataset": "want_dataset", "input_table": "want_table"})
    tables = table_kind(catalog).select("project", F.col("dataset").alias("input_dataset"),
                                        F.col("table").alias("input_table"), "kind")
    # one equi-join per width of a request: all datasets, a whole dataset, a table
    every, all_tables = F.col("want_dataset") == "*", F.col("want_table") == "*"
    by_width = ((every, ["project"]), (~every & all_tables, ["project", "input_dataset"]),
                (~every & ~all_tables, ["project", "input_dataset", "input_table"]))
    wanted = {"project": "input_project", "input_dataset": "want_dataset", "input_table": "want_table"}
    out = None
    for width, keys in by_width:
        asked = named.where(width)
        hit = reduce(lambda a, b: a & b, [asked[wanted[k]] == tables[k] for k in keys])
        found = asked.join(tables, hit).drop("project", "want_dataset", "want_table")
        out = found if out is None else out.unionByName(found)
    return out.unionByName(shards)


def routed(plan: DataFrame) -> DataFrame:
    """Export chosen for each physical table: partitions, select, shards, list or none."""
    has_days, has_select = F.col("days_before_export") > 0, F.col("select_date_for_exporting") != ""
    has_names = F.col("table_name_pattern") != ""
    kind = F.col("kind")
    by_select = F.when(has_select, "select").otherwise("none")
    route = (F.when(kind.isin("int_partition", "no_partition"), by_select)
             .when(kind == "time_partition", F.when(has_days, "partitions").otherwise(by_select))
             .when(kind == "shard_table_day", F.when(has_days, "shards").when(has_select, "select")
                   .when(has_names, "list").otherwise("none"))
             .when(kind == "shard_table", F.when(has_names, "list").when(has_select, "select").otherwise("none")))
    return plan.where(kind != "view").withColumn("route", route)


def duplicates(plan: DataFrame) -> DataFrame:
    return (plan.where("kind <> 'view'").groupBy("input_project", "input_dataset", "input_table")
            .agg(F.count("*").alias("n")).where("n > 1"))


def checked_config(config: DataFrame) -> DataFrame:
    """Typed configuration with an ``error`` column naming the first bad field."""
    def days(c):
        return F.when(F.col(c) == "", 0).otherwise(F.expr(f"try_cast({c} as int)"))

    bucket = F.regexp_replace(F.regexp_replace("bucket", "^[a-z0-9]+://", ""), "/$", "")
    df = config.withColumns({
        "days_before_remove": days("days_before_remove"), "days_before_export": days("days_before_export"),
        "bucket": bucket, "storage_class": F.when(F.col("storage_class") == "", "standard").otherwise(F.col("storage_class"))})
    error = (F.when(F.col("input_project").isin("", "*"), "project")
             .when(F.col("input_dataset") == "", "dataset")
             .when((F.col("input_dataset") != "*") & (F.col("input_table") == ""), "table")
             .when(F.col("days_before_remove").isNull(), "days_before_remove")
             .when(F.col("days_before_export").isNull(), "days_before_export")
             .when(~F.col("remove_orig_data").isin("Y", "N"), "remove_orig_data")
             .when(F.col("bucket").contains("/"), "bucket"))
    return df.withColumn("error", error)
