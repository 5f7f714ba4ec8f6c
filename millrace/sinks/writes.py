"""Table writes: dispositions, day replacement, upserts, layouts and text sinks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.functions.text import word_line
from millrace.sinks.archive import write_partitioned

# load dispositions and the save mode of each (fixed values)
DISPOSITIONS = {"append": "append", "truncate": "overwrite", "empty": "errorifexists"}


def load(df: DataFrame, path: str, disposition: str = "append", fmt: str = "parquet") -> None:
    df.write.mode(DISPOSITIONS[disposition]).format(fmt).save(path)


def replace_day(df: DataFrame, path: str, day: str, key: str = "dt") -> None:
    """Delete and insert of one day: only that partition is overwritten."""
    write_partitioned(df.withColumn(key, F.lit(day)), key, path)


def replace_table(spark: SparkSession, name: str, select: str, path: str) -> None:
    """Create or replace a table from a query."""
    spark.sql(select).write.mode("overwrite").option("path", path).saveAsTable(name)


def with_status(table: DataFrame, done: DataFrame, key: str, status: str = "complete") -> DataFrame:
    """Keyed status update of a table as a new version of it."""
    touched = done.select(F.col(key).alias("_k"), F.lit(status).alias("_s")).distinct()
    out = table.join(touched, table[key].eqNullSafe(F.col("_k")), "left")
    return out.withColumn("status", F.coalesce("_s", "status")).drop("_k", "_s")


def newest(log: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Latest row per key of an append-only log, reduced before it is shuffled."""
    rest = [c for c in log.columns if c != key and c not in order]
    top = log.groupBy(key).agg(F.max_by(F.struct(*order, *rest), F.struct(*order)).alias("_r"))
    return top.select(key, *[F.col(f"_r.{c}").alias(c) for c in order + rest])


def export_csv(df: DataFrame, path: str, rows: int = 1_000_000) -> None:
    """CSV with a header, in sharded files of at most ``rows`` rows."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows).csv(path, header=True)


def write_word_counts(counts: DataFrame, path: str) -> None:
    counts.select(word_line(F.col("word"), F.col("n"))).write.mode("overwrite").text(path)


# layouts compared by the benchmark (fixed values)
LAYOUTS = ("plain", "partitioned", "zstd", "sorted")


def write_layout(df: DataFrame, layout: str, key: str, path: str) -> None:
    writer = {"plain": lambda: df.write, "partitioned": lambda: df.hint("rebalance", key).write.partitionBy(key),
              "zstd": lambda: df.write.option("compression", "zstd"),
              "sorted": lambda: df.hint("rebalance", key).sortWithinPartitions(key).write}[layout]()
    writer.mode("overwrite").parquet(path)


def clean_partitioned(df: DataFrame, key: str, path: str, name: str) -> None:
    """Drop rows without a partition value, write by partition, register and count statistics."""
    spark = df.sparkSession
    write_partitioned(df.where(F.col(key).isNotNull()), key, path)
    spark.catalog.dropTempView(name)
    spark.sql(f"drop table if exists {name}")
    spark.catalog.createTable(name, path, source="parquet")
    spark.catalog.recoverPartitions(name)
    spark.sql(f"analyze table {name} compute statistics for all columns")


# partition column of each fact table of the retail star (fixed values)
FACT_PARTITIONS = {"store_sales": "ss_sold_date_sk", "store_returns": "sr_returned_date_sk", "catalog_sales": "cs_sold_date_sk",
                   "catalog_returns": "cr_returned_date_sk", "web_sales": "ws_sold_date_sk",
                   "web_returns": "wr_returned_date_sk", "inventory": "inv_date_sk"}


def save_star(star, path: str, names: tuple[str, ...], partitioned: bool = True,
              dated_only: bool = False) -> None:
    """Store tables of a star, facts partitioned by their date, for ``Star.stored``.

    ``dated_only`` leaves out the fact rows without a date, as the benchmark's
    loader does; a star stored so has fewer rows than the one it is made from.
    """
    for name in names:
        key = FACT_PARTITIONS.get(name) if partitioned else None
        if key is None:
            star.table(name).write.mode("overwrite").parquet(f"{path}/{name}")
        else:
            rows = star.table(name)
            write_partitioned(rows.where(F.col(key).isNotNull()) if dated_only else rows, key, f"{path}/{name}")


# order and item of each fact table and its returns (fixed values)
FACT_BUCKETS = {"store_sales": ("ss_ticket_number", "ss_item_sk"), "store_returns": ("sr_ticket_number", "sr_item_sk"),
                "catalog_sales": ("cs_order_number", "cs_item_sk"), "catalog_returns": ("cr_order_number", "cr_item_sk"),
                "web_sales": ("ws_order_number", "ws_item_sk"), "web_returns": ("wr_order_number", "wr_item_sk")}


def save_bucketed_star(star, path: str, prefix: str, names: tuple[str, ...], buckets: int,
                       columns: dict[str, tuple[str, ...]] | None = None) -> None:
    """Store tables of a star for ``Star.bucketed``: sales and returns bucketed and sorted by order and item.

    ``columns`` names those that readers of the stored star need; tables it does not name have all.

    All fact tables have the same number of buckets, one file each, so a sale
    and its return are in buckets of one number and their joins need no shuffle.
    """
    for name in names:
        rows, keys = star.table(name), FACT_BUCKETS.get(name)
        rows = rows.select(*columns[name]) if columns and name in columns else rows
        writer = rows.write
        if keys:
            # the shuffle deals rows as buckets do
            writer = rows.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
        writer.mode("overwrite").option("path", f"{path}/{name}").saveAsTable(prefix + name)


def run_dated(spark: SparkSession, select: str, root: str, run_time: dt.datetime, prefix: str = "your_table") -> str:
    """Scheduled query: ``:run_date`` and ``:run_time`` in the text, the date in the target."""
    path = f"{root}/{prefix}_{run_time:%Y%m%d}"
    spark.sql(select, args={"run_date": run_time.date(), "run_time": run_time}).write.mode("append").parquet(path)
    return path


def schema_ddl(fields: DataFrame) -> DataFrame:
    """``(a INTEGER,b STRING)`` per table from rows of table, pos, name and type."""
    line = F.concat_ws(" ", "name", "type")
    # a table has a few dozen columns
    cols = fields.groupBy("table").agg(F.sort_array(F.collect_list(F.struct("pos", line.alias("line")))).alias("c"))
    return cols.select("table", F.concat(F.lit("("), F.array_join("c.line", ","), F.lit(")")).alias("ddl"))
