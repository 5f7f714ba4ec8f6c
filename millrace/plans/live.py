"""Streaming jobs that get the event table in several batches, out of order, through restarts and faults."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions import runs
from millrace.operators import observed
from millrace.operators.ranking import cut_points, slot_of
from millrace.operators.relational import match
from millrace.plans.jobs import changes
from millrace.plans.streams import finished, keyed_messages, known_users, once, payload_messages, text_messages
from millrace.registry import Tables, query
from millrace.session import scratch
from millrace.sources.numbered import numbered_stream
from millrace.streaming import appends, delivery, enrich, multiset, windows

col = F.col
#: batches of a job, and the longest that a message is under way
BATCHES, LATE = 4, 3600
DELAY = f"{LATE} seconds"


def fed(t: Tables, rows: DataFrame, at: Column, name: str, start: Callable[[DataFrame, str], list[StreamingQuery]], batches: int = BATCHES) -> str:
    """Hand rows to a job in stretches of ``at``; the job is started anew for each one and goes on from its checkpoint.

    A stretch stands in few tasks where the table is in order, so its rows are dealt to a file per core.
    """
    path, cores = scratch(t.spark, name), t.spark.sparkContext.defaultParallelism
    numbered = rows.withColumn("_at", at.cast("double"))
    numbered = numbered.withColumn("_batch", slot_of(col("_at"), cut_points(numbered, "_at", batches)))
    for i in range(batches):
        numbered.where(col("_batch") == i).drop("_at", "_batch").repartition(cores).write.mode("append").parquet(path + "/in")
        for q in start(t.spark.readStream.schema(rows.schema).parquet(path + "/in"), path):
            finished(q)
    return path


def arrival() -> Column:
    """Events are under way for up to an hour, so they overtake each other."""
    return F.unix_micros("ts") / 1e6 + col("event_id") * 7919 % (LATE + 1)


def published(events: DataFrame) -> DataFrame:
    return events.withColumn("publish_time", col("ts"))


def appended(of: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, str], list[StreamingQuery]]:
    return lambda events, path: [appends.append_rows(of(published(events)), path + "/rows", path + "/checkpoint")]


# ---- windows over many batches ---------------------------------------------

@query
def t1_disordered_words(t: Tables):
    """Words per 15 seconds from four batches with events out of order; the delay covers the disorder."""
    path = fed(t, t.events, arrival(), "disordered", appended(lambda e: windows.window_rows(windows.windowed_words(text_messages(t, e), delay=DELAY))))
    return t.spark.read.parquet(path + "/rows").select("word", "count", "window_start")


@query
def t3_disordered_users(t: Tables):
    def users(events: DataFrame) -> DataFrame:
        p = windows.parsed(payload_messages(t, events)).where("event_name = 'error' and step_name is null")
        return windows.users_in_windows(p, delay=DELAY).select("user_id", col("w.start").alias("window_start"), "events_in_window")

    return t.spark.read.parquet(fed(t, t.events, arrival(), "disordered", appended(users)) + "/rows")


@query
def t4_enriched_batches(t: Tables):
    """Enrichment of four batches, started anew for each."""
    countries, history = known_users(t)
    path = fed(t, t.events, arrival(), "enriched", lambda events, path: enrich.start_enrichment(
        payload_messages(t, published(events)), countries, history, "error", path, path + "/checkpoint", DELAY))
    out = t.spark.read.parquet(path + "/result")
    return out.groupBy("user_id", "window_start", "country").agg(F.sum(F.size("events")).alias("history"))


@query
def j19_disordered_streams(t: Tables):
    """Daily views and clicks of each user from two streams in four batches."""
    def both(events: DataFrame) -> DataFrame:
        daily = [windows.users_in_windows(events.where(col("event_type") == kind).select("publish_time", "user_id"), "1 day", DELAY) for kind in ("view", "click")]
        return windows.cogrouped(*daily, "events_in_window", "events_in_window")

    out = t.spark.read.parquet(fed(t, t.events, arrival(), "cogrouped", appended(both)) + "/rows")
    return out.select(F.date_trunc("day", "at").alias("day"), "user_id", col("left_value").alias("views"), col("right_value").alias("clicks"))


# ---- state, metrics, sources -----------------------------------------------

def multisets(t: Tables) -> str:
    def start(events: DataFrame, path: str) -> list[StreamingQuery]:
        return [multiset.start_multisets(events, path + "/out", path + "/checkpoint", width=10)]

    events = changes(t).select(col("event_type").alias("key"), col("k").cast("bigint").alias("value"), col("event_id").alias("at"), "step")
    return once(t, "multisets", lambda: fed(t, events, col("at"), "multisets", start)) + "/out"


@query
def g20_stream_multiset(t: Tables):
    """The multisets after the last of four batches."""
    path = multisets(t)
    out = multiset.current(t.spark, path, multiset.last_batch(t.spark, path))
    return out.select(col("key").alias("event_type"), col("value").cast("int").alias("k"), "n")


@query
def g20_stream_median(t: Tables):
    path = multisets(t)
    out = multiset.lower_medians(t.spark, path, multiset.last_batch(t.spark, path))
    return out.select(col("key").alias("event_type"), col("median").cast("double").alias("median"))


def document_lines(t: Tables) -> DataFrame:
    return t.documents.select(F.explode(F.split(F.concat("text", F.lit("\n\n  ")), "\n")).alias("line"))


@query
def g18_observed_metrics(t: Tables):
    """Counters that the write of the word counts reports of its input, and what it wrote."""
    path = scratch(t.spark, "observed")
    seen = observed.write_observed(observed.word_rows(document_lines(t)), observed.counted_words, observed.word_metrics(), path)
    written = t.spark.read.parquet(path).agg(F.sum("n").alias("written"))
    return written.select(*[F.lit(seen[m]).cast("int" if m in ("min_len", "max_len") else "bigint").alias(m) for m in observed.WORD_METRICS],
                          (F.lit(seen["word_lengths"]) / F.lit(seen["words"])).alias("mean_len"), "written")


@query
def g18_stream_metrics(t: Tables):
    """The same counters from the batches of a stream."""
    def start(lines: DataFrame, path: str) -> list[StreamingQuery]:
        return [observed.start_observed(lines, path + "/out", path + "/checkpoint")]

    path = fed(t, document_lines(t), F.xxhash64("line") % 1000, "metrics", start)
    return observed.summed(t.spark.read.parquet(path + "/out/metrics").drop("batch"))


@query
def s14_numbered_stream(t: Tables):
    """Numbers from an unbounded source that is stopped and started again, matched with the orders of the same number."""
    path = scratch(t.spark, "numbers")
    last = t.orders.agg(F.max("o_orderkey")).first()[0]

    def start() -> StreamingQuery:
        rows = numbered_stream(t.spark, last=last, rows=last // 8 + 1)
        return rows.writeStream.format("parquet").option("path", path + "/rows").option("checkpointLocation", path + "/checkpoint").start()

    q = start()
    while q.isActive and (q.lastProgress is None or q.lastProgress["batchId"] < 2):
        time.sleep(0.05)
    q.stop()
    q = start()
    q.processAllAvailable()
    q.stop()
    rows = t.spark.read.parquet(path + "/rows")
    return match(rows, t.orders, num="o_orderkey").groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.max(F.length("text")).cast("bigint").alias("longest"))


@query
def k15_ledger_batches(t: Tables):
    """The ledger of four batches: their rows, and whether each begins where the one before ends."""
    path = fed(t, t.events.select("event_id"), col("event_id"), "ledger", lambda e, path: [appends.append_batches(e, path + "/table", path + "/checkpoint")]) + "/table"
    rows = appends.committed(t.spark, path).groupBy("batch").agg(F.count("*").alias("rows"), F.min("row_offset").alias("lo"), F.max("row_offset").alias("hi"),
                                                                F.count_distinct("row_offset").alias("offsets"))
    fits = (col("lo") == col("first")) & (col("hi") + 1 == col("next")) & (col("offsets") == col("rows"))
    return appends.ledger(t.spark, path).join(rows, "batch").agg(F.sum("rows").alias("rows"), F.count("*").alias("batches"), F.max("next").alias("next"),
                                                                F.bool_and(fits).alias("contiguous"))


# ---- faults -----------------------------------------------------------------

def faulty(rows: DataFrame, attempt: int) -> DataFrame:
    """A sink with planted faults: keys that are no number, and events that fail once, twice or until they are sent again."""
    event = F.get_json_object(F.decode("data", "UTF-8"), "$.event_id").cast("bigint")
    resent = F.coalesce(col("attributes")["round"], F.lit("")) != ""
    reason = (F.when(F.expr("try_cast(attributes['uid'] as bigint) is null"), "bad key")
              .when((event % 97 == 0) & ~resent, "unavailable")
              .when((event % 13 == 0) & F.lit(attempt <= 2), "unavailable")
              .when((event % 11 == 0) & F.lit(attempt <= 1), "timeout"))
    return rows.withColumn("reason", reason)


def repaired(letters: DataFrame) -> DataFrame:
    """Keys lose the letter before their number."""
    fixed = F.transform_values("attributes", lambda k, v: F.when(k == "uid", F.ltrim(v, F.lit("x"))).otherwise(v))
    return letters.withColumn("attributes", fixed)


def delivered(t: Tables) -> str:
    valid = col("attributes")["uid"].isNotNull()

    def start(events: DataFrame, path: str) -> list[StreamingQuery]:
        return [delivery.start_delivery(keyed_messages(t, published(events)), faulty, path + "/first", path + "/check1", wait=0.0, valid=valid)]

    def run() -> str:
        path = fed(t, t.events, col("event_id"), "delivery", start)
        finished(delivery.start_resending(t.spark, path + "/first/dead_letters", repaired, faulty, path + "/again", path + "/check2", wait=0.0, valid=valid))
        return path

    return once(t, "delivery", run)


@query
def t11_deliveries(t: Tables):
    """Landed rows by round and attempt."""
    path = delivered(t)
    out = [t.spark.read.parquet(f"{path}/{name}/rows").select(F.lit(name).alias("round"), "attempt", "data") for name in ("first", "again")]
    return out[0].union(out[1]).groupBy("round", "attempt").agg(F.count("*").alias("n"), F.count_distinct("data").alias("events"))


@query
def t10_sent_again(t: Tables):
    """Dead letters of both rounds by reason and attempts."""
    path = delivered(t)
    out = [t.spark.read.parquet(f"{path}/{name}/dead_letters").select(F.lit(name).alias("round"), col("attributes")["reason"].alias("reason"),
                                                                    col("attributes")["attempts"].cast("int").alias("attempts")) for name in ("first", "again")]
    return out[0].union(out[1]).groupBy("round", "reason", "attempts").agg(F.count("*").alias("n"))


@query
def u2_event_runs(t: Tables):
    """Runs of equal events of a user on a day, whose allowed gap follows the run."""
    at = F.unix_micros("ts") / 1e6
    rows = t.events.select(col("user_id").cast("bigint").alias("user_id"), F.to_date("ts").alias("day"), "event_type", col("event_id").cast("bigint").alias("event_id"), at.alias("at"))
    return runs.event_runs(rows)
