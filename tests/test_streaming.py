"""Streaming jobs over several batches: restart, late rows, repeated keys, bad rows."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from millrace.streaming import enrich, messages, routing, windows

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def send(spark, folder, rows):
    """Rows of (payload, attributes, seconds) as one more file of the message folder."""
    data = [(bytearray(p, "utf-8"), a, T0 + dt.timedelta(seconds=s)) for p, a, s in rows]
    spark.createDataFrame(data, messages.MESSAGE).coalesce(1).write.mode("append").parquet(folder + "/in")


def drain(query):
    query.awaitTermination()
    assert query.exception() is None


def words_run(spark, folder):
    lines = messages.decoded(messages.message_files(spark, folder + "/in", per_batch=1))
    out = windows.window_rows(windows.windowed_words(lines), F.lit(T0))
    drain(out.writeStream.format("parquet").option("path", folder + "/out").option("checkpointLocation", folder + "/check")
          .trigger(availableNow=True).start())
    rows = spark.read.parquet(folder + "/out").collect()
    return sorted((r["word"], r["count"], int((r["window_start"] - T0).total_seconds())) for r in rows)


def test_window_counts_survive_a_restart_and_drop_late_rows(spark, folder):
    send(spark, folder, [("a b", {}, 1), ("a", {}, 14), ("a", {}, 16)])
    send(spark, folder, [("b", {}, 40)])
    first = words_run(spark, folder)
    assert first == [("a", 1, 15), ("a", 2, 0), ("b", 1, 0)]
    send(spark, folder, [("late", {}, 2), ("c", {}, 41), ("d", {}, 100)])
    assert words_run(spark, folder) == sorted(first + [("b", 1, 30), ("c", 1, 30)])


def test_enrichment_and_error_rows(spark, folder):
    send(spark, folder, [('{"user_id": "1", "event_name": "logout", "region": "x"}', {}, 1),
                         ('{"user_id": "1", "event_name": "logout", "region": "x"}', {}, 2),
                         ('{"user_id": "2", "event_name": "login", "region": "x"}', {}, 2),
                         ('{"user_id": "3", "event_name": "logout", "region": "x"}', {}, 7), ('{"user_', {}, 8)])
    send(spark, folder, [('{"user_id": "9", "event_name": "logout", "region": "x"}', {}, 60)])
    countries = spark.createDataFrame([("1", "fr"), ("1", "it")], "user_id string, country string")
    history = spark.createDataFrame([("1", "2024-01-02", "view", "p"), ("1", "2024-01-01", "buy", "p"), ("1", "2024-02-01", "buy", "p"),
                                     ("2", "2024-01-01", "buy", "p")],
                                    "user_id string, event_date string, event_name string, device string")
    lines = messages.decoded(messages.message_files(spark, folder + "/in"))
    for q in enrich.start_enrichment(lines, countries, history, "logout", folder, folder + "/check"):
        drain(q)
    got = spark.read.parquet(folder + "/result").orderBy("user_id", "part").collect()
    assert [(r["user_id"], r["country"], r["part"], None if r["events"] is None else [e["event_date"] for e in r["events"]]) for r in got] == [
        ("1", "it", "2024-01", ["2024-01-01", "2024-01-02"]), ("1", "it", "2024-02", ["2024-02-01"]), ("3", None, None, None)]
    assert [r["step_name"] for r in spark.read.parquet(folder + "/result_err").collect()] == ["extractElement"]


def test_users_are_not_sent_to_all(spark):
    # sides that are small at run time were broadcast: their rows went through the driver
    users = spark.range(50).selectExpr("cast(id as string) as user_id", "named_struct('start', id) as w")
    countries = spark.range(50).selectExpr("cast(id as string) as user_id", "'fr' as country")
    history = spark.range(200).selectExpr("cast(id % 50 as string) as user_id", "'2024-01-01' as event_date", "'buy' as event_name", "cast(id as string) as device")
    full = enrich.enriched(users, countries, history)
    assert len(full.collect()) == 50
    joins = full._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # pieces of parts with more than 10,000 items are few
    assert joins.count("BroadcastHashJoin") <= 1 and joins.count("SortMergeJoin") >= 3


def routes(spark, folder, two_phase=False, fold_every=100):
    drain(routing.start_routing(messages.message_files(spark, folder + "/in", per_batch=1), folder, folder + "/check", two_phase,
                                fold_every))
    status = {r["uid"]: r["status"] for r in routing.current_status(spark, folder + "/status").collect()}
    duplicates = sorted(r["uid"] for r in spark.read.parquet(folder + "/duplicates").collect())
    dead = sorted(r["step_name"] for r in spark.read.parquet(folder + "/dead_letters").collect())
    return status, duplicates, dead


@pytest.mark.parametrize("two_phase, fold_every", [(False, 100), (True, 100), (True, 1)])
def test_routing_within_and_across_batches(spark, folder, two_phase, fold_every):
    known = spark.createDataFrame([("5", "{}", "pending"), ("6", "{}", "complete")], "uid string, data string, status string")
    routing.seed_status(known, folder + "/status")
    same = ('{"n": 1}', {"uid": "1"}, 1)
    send(spark, folder, [same, same, ('{"n": 2}', {"uid": "1"}, 2), ('{"n": 3}', {"uid": "5"}, 3), ('{"n": 4}', {}, 4)])
    send(spark, folder, [('{"n": 5}', {"uid": "1"}, 5), ('{"n": 6}', {"uid": "6"}, 6), ('{"n": 7}', {"uid": "bad"}, 7),
                         ('{"n": 8}', {"uid": "bad"}, 8)])
    status, duplicates, dead = routes(spark, folder, two_phase, fold_every)
    assert routing.generation(spark, folder + "/status") == (1 if fold_every == 1 else 0)
    assert status == {"1": "complete", "5": "complete", "6": "complete", "bad": "complete"}
    assert duplicates == ["1", "1", "1", "6"]
    assert dead == ["extractElement", "write"]
    log = routing.read_log(spark, folder + "/status").where("batch >= 0")
    assert log.where("status = 'new'").count() == (2 if two_phase else 0)


def test_a_repeated_batch_replaces_its_output(spark, folder):
    data = [(bytearray("{}", "utf-8"), {"uid": "1"}, T0), (bytearray("{}", "utf-8"), {"uid": "1"}, T0 + dt.timedelta(seconds=1))]
    batch = spark.createDataFrame(data, messages.MESSAGE)
    for _ in range(2):
        routing.route_batch(batch, 0, folder)
    assert spark.read.parquet(folder + "/duplicates").count() == 1
    assert routing.read_log(spark, folder + "/status").count() == 1
    for _ in range(2):
        routing.route_batch(batch, 1, folder, fold_every=1)
    assert spark.read.parquet(folder + "/duplicates").count() == 3


def test_source_needs_one_topic_choice(spark):
    with pytest.raises(ValueError):
        messages.kafka_messages(spark, "host:1")


def test_a_batch_reads_only_the_buckets_of_its_keys(spark, folder):
    known = spark.createDataFrame([(str(i), "{}", "complete") for i in range(500)], "uid string, data string, status string")
    routing.seed_status(known, folder + "/status")
    wanted = [r[0] for r in known.where("uid in ('3', '77')").select(routing.bucket_of(F.col("uid"))).distinct().collect()]
    some = routing.current_status(spark, folder + "/status", buckets=wanted)
    assert {"3", "77"} <= {r.uid for r in some.collect()}
    files = {f for f in routing.read_log(spark, folder + "/status", gen=0).where(F.col("bucket").isin(wanted)).select("_metadata.file_path").distinct().toPandas()["file_path"]}
    assert len(files) == len(wanted) < routing.BUCKETS
    assert some.count() == known.where(routing.bucket_of(F.col("uid")).isin(wanted)).count()


def test_large_parts_are_dealt_to_pieces(spark):
    from millrace.operators.nesting import nested
    rows = [("hot", i) for i in range(1000)] + [("cold", 1), (None, 2), (None, 3)]
    df = spark.createDataFrame(rows, "k string, v int")
    out = nested(df, ["k"], F.struct("v"), "items", F.lit("all"), most=100).collect()
    assert sorted(len(r["items"]) for r in out if r.k != "hot") == [1, 2]
    hot = [r for r in out if r.k == "hot"]
    assert {r.piece for r in hot} == set(range(10)) and max(len(r["items"]) for r in hot) < 150
    assert sorted(x.v for r in hot for x in r["items"]) == list(range(1000))
