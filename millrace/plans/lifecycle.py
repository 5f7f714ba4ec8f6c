"""Queries that run the export, snapshot and write jobs and read their results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions.money import total
from millrace.operators.relational import union_all
from millrace.registry import Tables, query
from millrace.session import scratch
from millrace.sinks import archive, clustered, folders, snapshots, writes

col = F.col
TODAY = dt.date(2001, 8, 31)


def orders(t: Tables):
    return t.orders.withColumn("day", F.to_date("o_orderdate"))


@query
def k1_export_partitions(t: Tables):
    """Months of orders that are at least two years old."""
    path = scratch(t.spark, "aged")
    archive.export_partitions(t.orders, F.trunc("o_orderdate", "month"), path, TODAY, 730)
    return archive.external_table(t.spark, path, "dt date").groupBy("dt").agg(F.count("*").alias("n"), total("o_totalprice").alias("worth"))


@query
def k2_export_select(t: Tables):
    t.orders.createOrReplaceTempView("archive_orders")
    path = scratch(t.spark, "select")
    archive.export_select(t.spark, "select o_orderkey, o_totalprice from archive_orders where o_totalprice > 200000", path, TODAY)
    return archive.external_table(t.spark, path, "dt date").groupBy("dt").agg(F.count("*").alias("n"))


def make_shards(t: Tables, prefix: str) -> list[str]:
    """One view of the orders per year, and one that is not a day."""
    names = []
    for year in range(1995, 2002):
        names.append(f"{prefix}{year}0101")
        t.orders.where(F.year("o_orderdate") == year).createOrReplaceTempView(names[-1])
    t.orders.where("o_orderstatus = 'P'").createOrReplaceTempView(f"{prefix}partial")
    return names + [f"{prefix}partial"]


@query
def k3_export_shards(t: Tables):
    names = make_shards(t, "shard_a_")
    path = scratch(t.spark, "shards")
    archive.export_shards(t.spark, [names[0], names[2], names[-1]], "shard_a_", path)
    return archive.external_table(t.spark, path, "suffix string").groupBy("suffix").agg(F.count("*").alias("n"))


@query
def k4_export_daily_shards(t: Tables):
    """All daily shards of the catalog up to a day; names match whatever their case."""
    make_shards(t, "shard_b_")
    names = [v.name for v in t.spark.catalog.listTables()]
    days = archive.daily_shards(names, "SHARD_B_", before=dt.date(1999, 12, 31))
    path = scratch(t.spark, "daily")
    archive.export_shards(t.spark, days, "shard_b_", path)
    return archive.external_table(t.spark, path, "suffix date").groupBy("suffix").agg(F.count("*").alias("n"))


@query
def k5_p15_guarded_read(t: Tables):
    """A partition filter is asked for before the table is read."""
    path = scratch(t.spark, "guarded")
    archive.export_partitions(t.orders, F.trunc("o_orderdate", "year"), path, TODAY, 0)
    table = archive.external_table(t.spark, path, "dt date")
    try:
        archive.require_partition_filter(table.where("o_totalprice > 0"), "dt")
        refused = False
    except ValueError:
        refused = True
    one = archive.require_partition_filter(table.where("dt = date'1998-01-01'"), "dt")
    return one.agg(F.count("*").alias("n"), F.lit(refused).alias("refused"))


def table_list(t: Tables):
    """Table metadata made from the parts: one table per part, in ten datasets."""
    k = col("p_partkey")
    return t.part.select(F.lit("main").alias("project"), F.concat(F.lit("ds"), k % 10).alias("dataset"),
                         F.concat(F.lit("t"), k).alias("table"),
                         F.when(k % 7 == 0, "VIEW").otherwise("TABLE").alias("table_type"),
                         F.when(k % 5 == 1, "range").alias("range_partitioning"),
                         F.when(k % 3 == 0, "DAY").alias("partitioning_type"))


def export_config(t: Tables):
    """Configuration rows: whole datasets, single tables and shards."""
    k = col("n_nationkey")
    dataset = F.when(k % 10 == 9, "*").otherwise(F.concat(F.lit("ds"), k % 10))
    table = F.when(k % 4 == 0, "*").when(k % 4 == 1, F.concat(F.lit("t"), k)).when(k % 4 == 2, F.lit("log{YYYYMMDD}")).otherwise("log*")
    return t.nation.select(
        F.lit("main").alias("input_project"), dataset.alias("input_dataset"), table.alias("input_table"),
        (k % 3 * 30).alias("days_before_export"), F.when(k % 2 == 0, "select 1").otherwise("").alias("select_date_for_exporting"),
        F.when(k % 5 == 0, "a,b").otherwise("").alias("table_name_pattern"))


def export_plan(t: Tables):
    return archive.expanded(export_config(t), table_list(t))


@query
def k6_export_routes(t: Tables):
    return archive.routed(export_plan(t)).groupBy("kind", "route").agg(F.count("*").alias("n"))


@query
def k7_duplicate_tables(t: Tables):
    return archive.duplicates(export_plan(t))


@query
def k7_refused_snapshots(t: Tables):
    """Snapshots of a plan that names tables twice are refused whole; without the repeated ones they are taken."""
    root, now = scratch(t.spark, "refused"), dt.datetime(2024, 1, 1)
    plan = export_plan(t)
    rows = lambda dataset, table: t.orders.where(col("o_orderkey") % 100 == F.lit(len(dataset + table)))
    try:
        snapshots.take_snapshots(plan, rows, root, now)
        refused = False
    except ValueError:
        refused = not folders.children(t.spark, root)
    keys = ["input_project", "input_dataset", "input_table"]
    once = plan.join(archive.duplicates(plan), keys, "left_anti")
    few = once.where("kind <> 'view'").orderBy(*keys).limit(3)
    taken = snapshots.take_snapshots(few, rows, root, now)
    return archive.duplicates(plan).agg(F.count("*").alias("repeated"), F.lit(refused).alias("refused"), F.lit(len(taken)).alias("taken"))


@query
def k8_table_kinds(t: Tables):
    return archive.table_kind(table_list(t)).groupBy("kind").agg(F.count("*").alias("n"))


@query
def k9_k10_snapshots(t: Tables):
    """Two copies; one is expired, and snapshot datasets are not copied again."""
    root = scratch(t.spark, "snapshots")
    day = dt.datetime(2024, 1, 1)
    snapshots.take_snapshot(t.orders, root, "sales", "orders", day)
    snapshots.take_snapshot(t.customer, root, "sales", "customer", day + dt.timedelta(days=5))
    again = snapshots.take_snapshot(t.orders, root, "sales_snapshot", "orders", day)
    gone = snapshots.expire_snapshots(t.spark, root, day + dt.timedelta(days=8))
    left = [c for c in folders.children(t.spark, f"{root}/sales_snapshot")]
    copies = [t.spark.read.parquet(f"{root}/sales_snapshot/{c}").agg(F.lit(c).alias("name"), F.count("*").alias("n")) for c in left]
    return union_all(*copies).select("name", "n", F.lit(len(gone)).alias("expired"), F.lit(again is None).alias("skipped"))


@query
def k11_dispositions(t: Tables):
    path = scratch(t.spark, "loads")
    writes.load(t.region, path, "empty")
    writes.load(t.region, path, "append")
    writes.load(t.region, path, "truncate")
    writes.load(t.region, path)
    try:
        writes.load(t.region, path, "empty")
        refused = False
    except Exception:  # any write error: the folder is not empty
        refused = True
    return t.spark.read.parquet(path).groupBy("r_name").agg(F.count("*").alias("n"), F.lit(refused).alias("refused"))


@query
def k12_replace_day(t: Tables):
    """Loading a day again replaces it and leaves the others alone."""
    path = scratch(t.spark, "days")
    for year in (1997, 1998, 1997):
        writes.replace_day(t.orders.where(F.year("o_orderdate") == year), path, f"{year}-01-01")
    return t.spark.read.parquet(path).groupBy(col("dt").cast("string").alias("dt")).agg(F.count("*").alias("n"))


@query
def k13_replace_table(t: Tables):
    t.orders.createOrReplaceTempView("replace_orders")
    name = "replaced_" + scratch(t.spark, "x").rsplit("-", 1)[1]
    for status in ("F", "O"):
        writes.replace_table(t.spark, name, f"select * from replace_orders where o_orderstatus = '{status}'", scratch(t.spark, "table"))
    return t.spark.table(name).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query
def k14_status_update(t: Tables):
    table = t.customer.select(col("c_custkey").cast("string").alias("uid"), F.lit("new").alias("status"))
    done = t.orders.where("o_orderstatus = 'F'").select(col("o_custkey").cast("string").alias("uid"))
    return writes.with_status(table, done, "uid").groupBy("status").agg(F.count("*").alias("n"))


@query
def k14_newest_row(t: Tables):
    log = t.events.select("user_id", "event_id", "event_type", "value")
    return writes.newest(log, "user_id", ["event_id"])


@query
def k16_csv_export(t: Tables):
    path = scratch(t.spark, "csv")
    writes.export_csv(t.customer, path)
    return t.spark.read.csv(path, header=True, inferSchema=True).groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query
def k17_word_lines(t: Tables):
    path = scratch(t.spark, "words")
    writes.write_word_counts(t.events.groupBy(col("event_type").alias("word")).agg(F.count("*").alias("n")), path)
    return t.spark.read.text(path)


@query
def k18_layouts(t: Tables):
    out = []
    root = scratch(t.spark, "layouts")
    for layout in writes.LAYOUTS:
        writes.write_layout(orders(t).withColumn("year", F.year("day")), layout, "year", f"{root}/{layout}")
        df = t.spark.read.parquet(f"{root}/{layout}")
        folders_ = F.count_distinct(F.regexp_extract("_metadata.file_path", "year=([0-9]+)", 1)) - F.lit(int(layout != "partitioned"))
        packed = F.min(F.col("_metadata.file_name").contains(".zstd."))
        out.append(df.groupBy("year").agg(F.count("*").alias("n"), total("o_totalprice").alias("worth"), packed.alias("zstd"),
                                          folders_.alias("folders")).withColumn("layout", F.lit(layout)))
    return union_all(*out)


@query
def k18_clustered(t: Tables):
    """Lines in as many files as they come and along a curve over ship date and part: files that a sixteenth of either column may need."""
    root, files = scratch(t.spark, "clustered"), 64
    lines = t.lineitem.select("l_orderkey", "l_shipdate", "l_partkey", "l_extendedprice")
    lines.repartition(files).write.parquet(f"{root}/plain")
    clustered.write_clustered(lines, ["l_shipdate", "l_partkey"], files, f"{root}/clustered")
    out = []
    for column in ("l_shipdate", "l_partkey"):
        low, high = lines.agg(F.percentile_approx(column, [0.5, 0.5625], 1000).alias("p")).first()["p"]
        plain, curve = [clustered.files_that_may_hold(t.spark.read.parquet(f"{root}/{name}"), column, low, high).first() for name in ("plain", "clustered")]
        held = [t.spark.read.parquet(f"{root}/{name}").where(F.col(column).between(low, high)) for name in ("plain", "clustered")]
        out.append(held[1].agg(F.lit(column).alias("column_name"), F.lit(plain["files"]).cast("bigint").alias("files"), F.lit(4 * curve["read"] <= plain["read"]).alias("quarter"),
                               (F.count("*") == held[0].agg(F.count("*")).scalar()).alias("same_rows")))
    return union_all(*out)


@query
def k19_clean_partitions(t: Tables):
    """Orders without a month are dropped; the table has statistics."""
    name = "clean_" + scratch(t.spark, "x").rsplit("-", 1)[1]
    o = t.orders.withColumn("year", F.when(col("o_orderkey") % 10 != 0, F.year("o_orderdate")))
    writes.clean_partitioned(o, "year", scratch(t.spark, "clean"), name)
    return t.spark.table(name).groupBy("year").agg(F.count("*").alias("n"))


@query
def k21_dated_run(t: Tables):
    t.orders.createOrReplaceTempView("dated_orders")
    path = writes.run_dated(t.spark, "select o_orderkey, :run_time as run_time from dated_orders where to_date(o_orderdate) = :run_date",
                            scratch(t.spark, "runs"), dt.datetime(1997, 5, 5, 6, 0))
    return t.spark.read.parquet(path).groupBy(F.date_format("run_time", "yyyy-MM-dd HH:mm").alias("run")).agg(F.count("*").alias("n"))


@query
def k22_schema_ddl(t: Tables):
    """Column lists to DDL: one table per region, one column per nation."""
    kind = F.when(col("n_nationkey") % 2 == 0, "INTEGER").otherwise("STRING")
    return writes.schema_ddl(t.nation.select(F.concat(F.lit("t"), col("n_regionkey")).alias("table"), col("n_nationkey").alias("pos"),
                                             F.lower("n_name").alias("name"), kind.alias("type")))


@query
def k23_retention(t: Tables):
    path = scratch(t.spark, "retention")
    archive.export_partitions(t.orders, F.trunc("o_orderdate", "month"), path, TODAY, 0)
    gone = archive.drop_aged_partitions(t.spark, path, TODAY, 365)
    return archive.external_table(t.spark, path, "dt date").agg(
        F.count("*").alias("n"), F.min("dt").alias("first"), F.lit(len(gone)).alias("removed"))
