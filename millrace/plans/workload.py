"""Benchmark and workload analytics: results, job statistics, checks, log metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.money import half_up
from millrace.operators.ranking import percentiles
from millrace.operators.relational import match, union_all
from millrace.registry import Tables, query
from millrace.sinks import folders
from millrace.session import scratch

col = F.col

# phases of one benchmark query (fixed values)
PHASES = ("parsingTime", "analysisTime", "optimizationTime", "planningTime", "executionTime")
RESULT = ("timestamp bigint, iteration int, results array<struct<name: string, "
          + ", ".join(f"{p}: double" for p in PHASES) + ">>")
RUN_LINE = ("run_id string, category string, sn string, run_sn int, job_id string, client_start_time double, "
            "client_end_time double, client_duration bigint")


def result_rows(results: DataFrame) -> DataFrame:
    """One row per iteration and query of a benchmark result file."""
    r = results.select(col("timestamp").alias("ts"), F.concat(F.lit("iteration_"), col("iteration")).alias("iteration"),
                       F.explode("results").alias("r"))
    return r.select("ts", "iteration", col("r.name").alias("name"), *[col(f"r.{p}").alias(p) for p in PHASES])


def total_runtime(rows: DataFrame) -> DataFrame:
    """Seconds over all phases; the name loses its first character."""
    ms = sum((col(p) for p in PHASES[1:]), col(PHASES[0]))
    return rows.select("iteration", F.expr("substring(name, 2, 100)").alias("name"), (ms / 1000).alias("runtime"))


def run_lines(df: DataFrame) -> DataFrame:
    """Timing lines written as Python dictionaries, with single quotes."""
    return df.select(F.from_json("value", RUN_LINE, {"allowSingleQuotes": "true"}).alias("r")).select("r.*")


def job_facts(runs: DataFrame, jobs: DataFrame) -> DataFrame:
    """Client timings next to the statistics of the job that served them."""
    s = match(runs, jobs.withColumnRenamed("job_id", "stat_job"), job_id="stat_job").drop("stat_job")
    ms = F.timestamp_diff("MILLISECOND", "start_time", "end_time")
    return s.withColumn("job_duration", ms).withColumn(
        "avg_slots", F.when(col("job_duration") > 0, col("total_slot_ms") / col("job_duration")))


def run_summary(facts: DataFrame) -> DataFrame:
    """Minutes, slot time and slots per run, then their geometric mean over the runs."""
    per = facts.groupBy("run_id", "category", "run_sn").agg(
        half_up(F.sum("job_duration") / 60000, 2).alias("minutes"), F.sum("total_slot_ms").alias("slot_ms"),
        F.avg("avg_slots").alias("slots"))
    return per.agg(F.round(F.exp(F.avg(F.ln("minutes"))), 4).alias("minutes"),
                   F.round(F.exp(F.avg(F.ln("slot_ms"))), 2).alias("slot_ms"), F.round(F.avg("slots"), 6).alias("slots"))


def partition_use(docs: DataFrame) -> DataFrame:
    """Tables of analysed queries whose partition column appears in the predicates."""
    def name(c: Column) -> Column:
        return F.concat_ws(".", c["projectId"], c["datasetId"], c["tableId"])

    tables = docs.select("query_id", F.explode("predicates.tables").alias("t")).select(
        "query_id", name(col("t.table")).alias("table"),
        F.coalesce("t.timePartitionField.field", "t.rangePartitionField.field").alias("partition_field"))
    used = docs.select(col("query_id").alias("q"), F.explode("predicates.columns").alias("c")).select(
        "q", name(col("c.table")).alias("used_table"), col("c.columnName").alias("column")).distinct()
    on = {"query_id": "q", "table": "used_table", "partition_field": "column"}
    hit = match(tables, used, "left", **on)
    return hit.select("query_id", "table", "partition_field", col("column").isNotNull().alias("is_used"))


def value_check(df: DataFrame, name: str, condition: str, expected: int) -> DataFrame:
    """Row count under a condition against what it should be."""
    return df.where(condition).agg(F.lit(name).alias("name"), F.lit(expected).cast("bigint").alias("expected"),
                                   F.count("*").alias("actual")).withColumn("passed", col("actual") == col("expected"))


def exists_check(spark, path: str, name: str) -> DataFrame:
    """Whether a table is there, as a check that expects one."""
    found = int(folders.exists(spark, path))
    return spark.range(1).select(F.lit(name).alias("name"), F.lit(1).cast("bigint").alias("expected"),
                                 F.lit(found).cast("bigint").alias("actual"), F.lit(found == 1).alias("passed"))


# key-value benchmark lines that carry a metric, with their names (fixed values)
LOG_METRICS = (("[OVERALL], Throughput(ops/sec),", "Overall Throughput (ops/sec)"),
               ("[READ], 99thPercentileLatency(us),", "Read 99thPercentileLatency (us)"),
               ("[READ], 99.9PercentileLatency(us),", "Read 99.9PercentileLatency (us)"),
               ("[READ], 99.99PercentileLatency(us),", "Read 99.99PercentileLatency (us)"))


def log_metrics(lines: DataFrame, key: str) -> DataFrame:
    """One row per log with its metrics: throughput rounded, latencies in milliseconds."""
    number = F.trim(F.split("value", ",")[2]).cast("double")
    metric = F.lit(None).cast("string")
    for marker, name in LOG_METRICS:
        metric = F.when(col("value").contains(marker), name).otherwise(metric)
    found = lines.select(key, metric.alias("metric"), number.alias("number")).where("metric is not null")
    scaled = F.when(col("metric").contains("Throughput"), col("number")).otherwise(col("number") / 1000)
    # a log holds one line per metric
    return found.groupBy(key).pivot("metric", [n for _, n in LOG_METRICS]).agg(F.bround(F.max(scaled)).cast("bigint"))


def integer_tokens(lines: DataFrame) -> DataFrame:
    """Whole-number tokens of whitespace-separated text, all files together."""
    token = lines.select(F.explode(F.split("value", r"\s+")).alias("token"))
    return token.where(col("token").rlike("^[0-9]+$")).select(col("token").cast("bigint").alias("number"))


# ---- queries ---------------------------------------------------------------

def benchmark_results(t: Tables) -> DataFrame:
    """One result document per order, with three queries each."""
    k = col("o_orderkey")
    one = F.transform(F.sequence(F.lit(1), F.lit(3)), lambda i: F.struct(
        F.concat(F.lit("q"), i.cast("string")).alias("name"),
        *[((k % 100) * (j + 1) + i).cast("double").alias(p) for j, p in enumerate(PHASES)]))
    path = scratch(t.spark, "results")
    t.orders.select(k.alias("timestamp"), (k % 4).cast("int").alias("iteration"), one.alias("results")).write.json(path)
    return result_rows(t.spark.read.schema(RESULT).json(path))


@query
def m7_benchmark_rows(t: Tables):
    return benchmark_results(t).groupBy("iteration", "name").agg(F.count("*").alias("n"), F.sum("executionTime").alias("execution"))


@query
def m8_total_runtime(t: Tables):
    return total_runtime(benchmark_results(t)).groupBy("name").agg(F.round(F.sum("runtime"), 6).alias("runtime"))


def job_table(t: Tables) -> DataFrame:
    start = col("o_orderdate").cast("timestamp")
    return t.orders.select(
        F.concat(F.lit("job-"), col("o_orderkey")).alias("job_id"), start.alias("start_time"),
        F.timestamp_add("MILLISECOND", (col("o_orderkey") % 5000 + 1).cast("int"), start).alias("end_time"),
        (col("o_orderkey") * 1024).alias("total_bytes_processed"), (col("o_custkey") * 100 + 1).alias("total_slot_ms"))


def client_runs(t: Tables) -> DataFrame:
    """Timing lines of one query per order, in single quotes, some with text serial numbers."""
    k = col("o_orderkey")
    line = F.format_string(
        "{'run_id': '%d', 'category': 'retail', 'sn': %s, 'run_sn': %d, 'job_id': 'job-%d', 'client_start_time': %d.5, 'client_end_time': %d.75, 'client_duration': 250}",
        k % 10, F.when(k % 3 == 0, F.lit("'14b'")).otherwise((k % 99).cast("string")), k % 7, k, k, k)
    path = scratch(t.spark, "lines")
    t.orders.select(line).write.text(path)
    return run_lines(t.spark.read.text(path).select("value"))


@query
def m9_m10_j20_job_facts(t: Tables):
    facts = job_facts(client_runs(t), job_table(t))
    return facts.select("run_id", "sn", "run_sn", "job_id", "client_duration", "job_duration", "total_bytes_processed", "avg_slots")


@query
def m11_run_summary(t: Tables):
    return run_summary(job_facts(client_runs(t), job_table(t)))


@query
def m5_partition_use(t: Tables):
    """Predicate documents made from the orders, as nested JSON."""
    k = col("o_orderkey")
    table = F.struct(F.lit("main").alias("projectId"), F.lit("ds").alias("datasetId"), F.concat(F.lit("t"), k % 5).alias("tableId"))
    other = F.struct(F.lit("main").alias("projectId"), F.lit("ds").alias("datasetId"), F.lit("dim").alias("tableId"))
    field = F.when(k % 3 == 0, F.struct(F.lit("day").alias("field")))
    ranged = F.when(k % 3 == 1, F.struct(F.lit("bucket").alias("field")))
    kind = "struct<field: string>"
    tables = F.array(F.struct(table.alias("table"), field.alias("timePartitionField"), ranged.alias("rangePartitionField")),
                     F.struct(other.alias("table"), F.lit(None).cast(kind).alias("timePartitionField"),
                              F.lit(None).cast(kind).alias("rangePartitionField")))
    columns = F.array(F.struct(F.when(k % 2 == 0, "day").otherwise("bucket").alias("columnName"), table.alias("table")),
                      F.struct(F.lit("day").alias("columnName"), other.alias("table")))
    path = scratch(t.spark, "analysis")
    t.orders.select(k.alias("query_id"), F.struct(tables.alias("tables"), columns.alias("columns")).alias("predicates")).write.json(path)
    place = "struct<projectId: string, datasetId: string, tableId: string>"
    schema = (f"query_id bigint, predicates struct<tables: array<struct<table: {place}, timePartitionField: {kind}, "
              f"rangePartitionField: {kind}>>, columns: array<struct<columnName: string, table: {place}>>>")
    return partition_use(t.spark.read.schema(schema).json(path))


@query
def m6_checks(t: Tables):
    return union_all(value_check(t.orders, "orders have a customer", "o_custkey is null", 0),
                     value_check(t.lineitem, "no free lines", "l_extendedprice <= 0", 0),
                     value_check(t.region, "five regions", "true", 5),
                     value_check(t.events, "no errors", "event_type = 'error'", 0),
                     exists_check(t.spark, f"{t.sf_dir}/part.parquet", "parts are there"),
                     exists_check(t.spark, f"{t.sf_dir}/no_such_table.parquet", "a missing table is there"))


@query
def m12_integer_tokens(t: Tables):
    tokens = integer_tokens(t.documents.select(col("text").alias("value")))
    return tokens.agg(F.count("*").alias("n"), F.max("number").alias("largest"))


@query
def g15_token_percentiles(t: Tables):
    """High percentiles of the numbers pooled over all files."""
    lines = t.lineitem.select(F.concat_ws(" ", F.lit("took"), col("l_orderkey").cast("string"), F.lit("ns,"), col("l_partkey").cast("string")).alias("value"))
    return percentiles(integer_tokens(lines), "number", [0.99, 0.999, 0.9999]).select("share", F.round("value", 4).alias("value"))


@query
def f13_log_metrics(t: Tables):
    """One benchmark log per supplier, four metric lines among others."""
    k = col("s_suppkey")
    made = F.array(*[F.concat(F.lit(marker + " "), (k * (37 + 500 * i) + 250 * i).cast("string")) for i, (marker, _) in enumerate(LOG_METRICS)],
                   F.lit("[READ], Operations, 12"))
    out = log_metrics(t.supplier.select(k.alias("log"), F.explode(made).alias("value")), "log")
    return out.toDF("log", "throughput", "p99", "p999", "p9999")
