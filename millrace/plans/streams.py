"""Queries that run the streaming jobs over the event table until it is used up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from millrace.functions.text import words
from millrace.registry import Tables, query
from millrace.session import scratch
from millrace.streaming import appends, enrich, messages, routing, windows

col = F.col


def event_stream(t: Tables) -> DataFrame:
    raw = t.spark.read.parquet(f"{t.sf_dir}/events.parquet").schema
    s = messages.table_stream(t.spark, t.sf_dir, "events", raw)
    return s.withColumn("publish_time", col("ts").cast("timestamp"))


def finished(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def once(t: Tables, name: str, run: Callable[[], str]) -> str:
    """Folder of a job that is run once for all queries that look at its results."""
    done = t.__dict__.setdefault("_jobs", {})
    if name not in done:
        done[name] = run()
    return done[name]


def collected(stream: DataFrame, t: Tables, name: str) -> DataFrame:
    """Append a stream to a folder until its input ends, and read the folder."""
    path = scratch(t.spark, name)
    finished(appends.append_rows(stream, path + "/rows", path + "/checkpoint"))
    return t.spark.read.parquet(path + "/rows")


def text_messages(t: Tables, events: DataFrame | None = None) -> DataFrame:
    line = F.concat_ws(" ", col("event_type"), F.get_json_object("props", "$.k"))
    events = event_stream(t) if events is None else events
    return messages.decoded(events.select(line.cast("binary").alias("data"), "publish_time"))


@query
def t1_t2_s12_window_words(t: Tables):
    """Words per 15 seconds; the window still open at the end is not emitted."""
    out = collected(windows.window_rows(windows.windowed_words(text_messages(t))), t, "words")
    return out.select("word", "count", "window_start", "window_end", col("row_index").isNull().alias("unfilled"))


@query
def t1_window_words_batch(t: Tables):
    """The same counts from one batch over the whole table."""
    lines = t.events.select(F.concat_ws(" ", "event_type", F.get_json_object("props", "$.k")).alias("line"), col("ts").alias("publish_time"))
    one = lines.select("publish_time", F.explode(words(col("line"))).alias("word"))
    out = one.groupBy(F.window("publish_time", "15 seconds").alias("w"), "word").agg(F.count("*").alias("count"))
    return out.select("word", "count", col("w.start").alias("window_start"))


def payload_messages(t: Tables, events: DataFrame | None = None) -> DataFrame:
    """JSON events; every fiftieth is cut off in the middle."""
    body = F.to_json(F.struct(col("user_id").cast("string").alias("user_id"), col("event_type").alias("event_name"), F.lit("north").alias("region")))
    line = F.when(col("event_id") % 50 == 0, F.substring(body, 1, 12)).otherwise(body)
    events = event_stream(t) if events is None else events
    return messages.decoded(events.select(line.cast("binary").alias("data"), "publish_time"))


@query
def t3_users_in_windows(t: Tables):
    p = windows.parsed(payload_messages(t)).where("event_name = 'error' and step_name is null")
    out = windows.users_in_windows(p)
    return collected(out.select("user_id", col("w.start").alias("window_start"), "events_in_window"), t, "users")


def run_enrichment(t: Tables) -> str:
    return once(t, "enrichment", lambda: enrichment(t))


def enrichment(t: Tables) -> str:
    countries, history = known_users(t)
    path = scratch(t.spark, "enrich")
    for q in enrich.start_enrichment(payload_messages(t), countries, history, "error", path, path + "/checkpoint"):
        finished(q)
    return path


def known_users(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Country and earlier purchases of users."""
    countries = t.customer.where("c_custkey % 3 <> 0").select(col("c_custkey").cast("string").alias("user_id"), F.concat(F.lit("country "), col("c_nationkey")).alias("country"))
    history = t.events.where("event_type = 'purchase'").select(
        col("user_id").cast("string").alias("user_id"), F.date_format("ts", "yyyy-MM-dd").alias("event_date"),
        col("event_type").alias("event_name"), F.concat(F.lit("device "), col("event_id") % 3).alias("device"))
    return countries, history


@query
def t4_j19_enriched_events(t: Tables):
    out = t.spark.read.parquet(run_enrichment(t) + "/result")
    return out.groupBy("user_id", "window_start", "country").agg(F.sum(F.size("events")).alias("history"))


@query
def t5_step_failures(t: Tables):
    return t.spark.read.parquet(run_enrichment(t) + "/result_err").groupBy("step_name").agg(F.count("*").alias("n"))


def keyed_messages(t: Tables, events: DataFrame | None = None) -> DataFrame:
    """Messages with a ``uid`` attribute; some have none and some a bad one."""
    body = F.to_json(F.struct("event_id", "user_id", F.round("value", 2).alias("cpc")))
    uid = F.when(col("event_id") % 40 == 1, F.concat(F.lit("x"), col("user_id"))).otherwise(col("user_id").cast("string"))
    attributes = F.when(col("event_id") % 25 == 0, F.create_map(F.lit("source"), F.lit("test"))).otherwise(F.create_map(F.lit("uid"), uid))
    events = event_stream(t) if events is None else events
    return events.select(body.cast("binary").alias("data"), attributes.alias("attributes"), "publish_time")


def run_routing(t: Tables, two_phase: bool) -> str:
    return once(t, f"routing {two_phase}", lambda: route(t, two_phase))


def route(t: Tables, two_phase: bool) -> str:
    path = scratch(t.spark, "routing")
    known = t.customer.where("c_custkey % 5 < 2").select(
        col("c_custkey").cast("string").alias("uid"), F.lit("{}").alias("data"),
        F.when(col("c_custkey") % 5 == 0, "complete").otherwise("pending").alias("status"))
    routing.seed_status(known, path + "/status")
    finished(routing.start_routing(keyed_messages(t), path, path + "/checkpoint", two_phase))
    return path


@query
def t6_t7_t8_status_log(t: Tables):
    """Keys that became complete during the run."""
    log = routing.read_log(t.spark, run_routing(t, False) + "/status").where("batch >= 0")
    return log.select("uid", "status", F.get_json_object("data", "$.event_id").cast("bigint").alias("event_id"))


@query
def t8_duplicates(t: Tables):
    d = t.spark.read.parquet(run_routing(t, False) + "/duplicates")
    return d.groupBy("uid").agg(F.count("*").alias("n"))


@query
def t9_two_phase_status(t: Tables):
    path = run_routing(t, True)
    log = routing.read_log(t.spark, path + "/status").where("batch >= 0").groupBy("status").agg(F.count("*").alias("n"))
    final = routing.current_status(t.spark, path + "/status").groupBy("status").agg(F.count("*").alias("n"))
    return log.select(F.lit("log").alias("kind"), "*").unionByName(final.select(F.lit("final").alias("kind"), "*"))


@query
def t10_k20_dead_letters(t: Tables):
    d = t.spark.read.parquet(run_routing(t, False) + "/dead_letters")
    return d.groupBy("step_name").agg(F.count("*").alias("n"))


@query
def t12_micro_appends(t: Tables):
    out = collected(event_stream(t).select("event_id", "event_type"), t, "appends")
    return out.groupBy("event_type").agg(F.count("*").alias("n"))


@query
def k15_offset_batches(t: Tables):
    path = scratch(t.spark, "offsets")
    finished(appends.append_batches(event_stream(t).select("event_id"), path, path + "/checkpoint"))
    return appends.committed(t.spark, path).agg(F.count("*").alias("n"), F.count_distinct("row_offset").alias("offsets"),
                                                     F.min("row_offset").alias("first"), F.max("row_offset").alias("last"))


@query
def t14_deduplicated(t: Tables):
    s = event_stream(t).withColumn("key", F.concat_ws("-", "user_id", "event_type"))
    return collected(windows.deduplicated(s, "key", "40 days").select("key"), t, "dedup")


@query
def j19_cogrouped_streams(t: Tables):
    """Daily views and clicks of each user from two streams."""
    def daily(kind: str) -> DataFrame:
        s = event_stream(t).where(col("event_type") == kind).select("publish_time", "user_id")
        return windows.users_in_windows(s, "1 day")

    both = windows.cogrouped(daily("view"), daily("click"), "events_in_window", "events_in_window")
    out = collected(both, t, "cogrouped")
    return out.select(F.date_trunc("day", "at").alias("day"), "user_id", col("left_value").alias("views"), col("right_value").alias("clicks"))
