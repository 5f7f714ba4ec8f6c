"""Sources, sinks, governance and workload jobs on small inputs."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from millrace.plans import governance, jobs, workload
from millrace.sinks import archive, folders, snapshots, writes
from millrace.sources import files, keyed_logs


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def put(folder, name, text):
    path = f"{folder}/{name}"
    with open(path, "w") as f:
        f.write(text)
    return path


def test_positional_json(spark, folder):
    path = put(folder, "a.json", '{"meta": {"x": 1},\n "data": [["1", "b", null],\n ["2", "c", "7"]]}')
    got = files.positional_json(spark, path, [("id", "int"), ("name", "string"), ("n", "bigint"), ("more", "string")])
    assert [tuple(r) for r in got.orderBy("id").collect()] == [(1, "b", None, None), (2, "c", 7, None)]


def test_pipe_delimited_drops_the_closing_separator_and_keeps_quotes(spark, folder):
    path = put(folder, "a.dat", '1|say "hi"|2.5|\n2||3|\n')
    got = files.pipe_delimited(spark, path, "id int, text string, v double").orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, 'say "hi"', 2.5), (2, None, 3.0)]


def test_config_rows_are_padded(spark, folder):
    path = put(folder, "c.csv", "project,dataset,table\np,d\nq,e,t\n")
    assert sorted(tuple(r) for r in files.job_config(spark, path).collect()) == [("p", "d", ""), ("q", "e", "t")]


def test_log_day_comes_from_the_file_name(spark, folder):
    put(folder, "grantblock_20240103.txt", '{"u1": [{"ip": "1"}, {"ip": "2"}]}\n{"u2": null}\n')
    lines = files.daily_logs(spark, folder, r"grantblock_(.*?)\.txt")
    got = keyed_logs.repeated_records(lines, keyed_logs.TUNNEL_BLOCK).orderBy("userkey").collect()
    assert [(r["userkey"], [x["ip"] for x in r["rec"]], r["dt"]) for r in got] == [
        ("u1", ["1", "2"], "20240103"), ("u2", [], "20240103")]


def test_null_lists_become_empty(spark):
    lines = spark.createDataFrame([('{"u": {"target": null, "authLevel": [1, 2], "hitDictLevel": null}}',)], "value string")
    r = keyed_logs.list_records(lines).first()
    assert (r["user_name"], r["target"], r["authLevel"], r["ip"], r["hitDictLevel"]) == ("u", [], [1, 2], [], "")


def test_struct_parameter_and_messages(spark):
    assert [tuple(r) for r in files.struct_rows(spark, [{"x": 1, "y": "a"}, {"x": 2, "y": "b"}]).collect()] == [(1, "a"), (2, "b")]
    assert [tuple(r) for r in files.numbered_rows(spark, 1, 2).collect()] == [(1, "string_value_1")]
    assert bytes(files.numbered_messages(spark, 2).first()["data"]) == b"Message number 1"


def test_shard_names():
    assert archive.shard_suffix("log_20240105", "log") == "2024-01-05"
    assert archive.shard_suffix("log_eu", "log") == "eu"
    names = ["LOG20240101", "log20240201", "log2024", "blog20240101", "log20240101x"]
    assert archive.daily_shards(names, "log") == ["LOG20240101", "log20240201"]
    assert archive.daily_shards(names, "log", dt.date(2024, 1, 15)) == ["LOG20240101"]


def test_missing_shard_is_an_error(spark):
    with pytest.raises(ValueError, match="no_such_shard"):
        archive.export_shards(spark, ["no_such_shard"], "no_", "/tmp/unused")


def test_partition_filter_guard(spark, folder):
    df = spark.range(20).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 4).cast("int")).alias("day"))
    archive.export_partitions(df, F.col("day"), folder + "/t", dt.date(2024, 1, 4), 1)
    table = archive.external_table(spark, folder + "/t", "dt date")
    assert table.count() == 15 and str(table.schema["dt"].dataType) == "DateType()"
    for open_query in (table, table.where("id > 3"), table.where("dt is not null")):
        with pytest.raises(ValueError):
            archive.require_partition_filter(open_query, "dt")
    assert archive.require_partition_filter(table.where("dt > '2024-01-01' and id > 3"), "dt").count() > 0


def test_retention_removes_folders(spark, folder):
    df = spark.range(6).select("id", F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    archive.export_partitions(df, F.col("day"), folder + "/t", dt.date(2024, 2, 1), 0)
    gone = archive.drop_aged_partitions(spark, folder + "/t", dt.date(2024, 1, 5), 2)
    assert gone == ["dt=2024-01-01", "dt=2024-01-02"]
    assert spark.read.parquet(folder + "/t").count() == 4


def test_config_check(spark):
    cols = "input_project, input_dataset, input_table, days_before_remove, days_before_export, remove_orig_data, bucket, storage_class".split(", ")
    data = [("p", "d", "t", "", "3", "Y", "store://b/", ""), ("*", "d", "t", "", "", "N", "", ""), ("p", "d", "t", "x", "", "N", "", ""),
            ("p", "d", "t", "", "", "maybe", "", ""), ("p", "d", "t", "", "", "N", "store://b/c", ""), ("p", "*", "", "1", "", "N", "", "cold")]
    got = archive.checked_config(spark.createDataFrame(data, cols)).collect()
    assert [r["error"] for r in got] == [None, "project", "days_before_remove", "remove_orig_data", "bucket", None]
    assert (got[0]["days_before_export"], got[0]["bucket"], got[0]["storage_class"]) == (3, "b", "standard")


def test_snapshots(spark, folder):
    now = dt.datetime(2024, 3, 1)
    df = spark.range(3)
    path = snapshots.take_snapshot(df, folder, "sales", "orders", now)
    assert path.endswith("sales_snapshot/orders_20240301")
    with pytest.raises(ValueError):
        snapshots.take_snapshot(df, folder, "sales", "orders", now)
    assert snapshots.take_snapshot(df, folder, "sales_snapshot", "orders_20240301", now) is None
    assert snapshots.expire_snapshots(spark, folder, now + dt.timedelta(days=6)) == []
    assert len(snapshots.expire_snapshots(spark, folder, now + dt.timedelta(days=7))) == 1
    assert not folders.exists(spark, path)


def test_status_update_and_newest(spark):
    table = spark.createDataFrame([("a", "new"), ("b", "new"), (None, "new")], "uid string, status string")
    done = spark.createDataFrame([("a",), ("a",), ("z",)], "uid string")
    assert sorted((tuple(r) for r in writes.with_status(table, done, "uid").collect()), key=str) == [
        ("a", "complete"), ("b", "new"), (None, "new")]
    log = spark.createDataFrame([("a", 1, 0, "x"), ("a", 1, 1, "y"), ("b", 3, 0, None)], "uid string, batch int, seq int, status string")
    assert sorted(tuple(r) for r in writes.newest(log, "uid", ["batch", "seq"]).collect()) == [("a", 1, 1, "y"), ("b", 3, 0, None)]


def test_schema_lists_become_ddl(spark, folder):
    for name, fields in (("item", [("a", "INTEGER"), ("b", "STRING")]), ("store", [("c", "FLOAT")])):
        put(folder, f"{name}.json", "\n".join(f'{{"table": "{name}", "pos": {i}, "name": "{n}", "type": "{k}"}}' for i, (n, k) in enumerate(fields)))
    got = writes.schema_ddl(spark.read.schema("table string, pos int, name string, type string").json(folder))
    assert sorted(tuple(r) for r in got.collect()) == [("item", "(a INTEGER,b STRING)"), ("store", "(c FLOAT)")]


def test_masking(spark):
    df = spark.createDataFrame([(1, "x", 2.5, dt.date(2024, 1, 1))], "k int, name string, pay double, day date")
    rules = [governance.Policy("t", "pay", ("boss",), ("clerk",)), governance.Policy("t", "day", (), ("clerk",))]
    assert tuple(governance.masked(df, "t", rules, "clerk").first()) == (1, "x", 0.0, dt.date(1970, 1, 1))
    with pytest.raises(PermissionError, match="day"):
        governance.masked(df, "t", rules, "boss")
    renamed = df.select(F.col("pay").alias("amount"))
    assert not governance.may_hold_masked(renamed, df, "t", rules, "clerk")
    assert governance.may_hold_masked(df.select("pay"), df, "t", rules, "clerk")
    assert not governance.may_hold_masked(df.select(F.lit("z").alias("pay")), df, "t", rules, "clerk")


def test_lineage_sees_through_renames(spark, folder):
    spark.range(3).select("id", F.col("id").alias("pay")).write.parquet(folder + "/t")
    df = spark.read.parquet(folder + "/t")
    rules = [governance.Policy("t", "pay", (), ("clerk",))]
    assert governance.masking_applied(df.select((F.col("pay") + 1).alias("x")), df, "t", rules, "clerk")
    assert governance.masking_applied(df.where("pay > 1").select("id"), df, "t", rules, "clerk")
    assert not governance.masking_applied(df.select("id"), df, "t", rules, "clerk")
    spark.range(3).select("id", F.col("id").alias("pay")).write.parquet(folder + "/other")
    assert not governance.masking_applied(spark.read.parquet(folder + "/other").select("pay"), df, "t", rules, "clerk")


def test_run_lines_accept_numbers_and_text(spark):
    text = ["{'run_id': '1', 'sn': 2, 'client_duration': 10}", "{'run_id': '1', 'sn': '14b', 'client_duration': 20}"]
    got = workload.run_lines(spark.createDataFrame([(t,) for t in text], "value string"))
    assert [r["sn"] for r in got.orderBy("client_duration").collect()] == ["2", "14b"]


def test_job_without_duration_has_no_slots(spark):
    runs = spark.createDataFrame([("j", "1")], "job_id string, run_id string")
    at = dt.datetime(2024, 1, 1)
    jobs = spark.createDataFrame([("j", at, at, 5)], "job_id string, start_time timestamp, end_time timestamp, total_slot_ms bigint")
    r = workload.job_facts(runs, jobs).first()
    assert (r["job_duration"], r["avg_slots"]) == (0, None)


def test_job_sheet_of_many_files_has_its_header_given_once(spark, tmp_path):
    path = str(tmp_path / "sheets")
    spark.createDataFrame([("p,d",), ("q,e,t",)], "value string").repartition(2).write.text(path)
    rows = files.job_config(spark, path, ["a", "b", "c"]).collect()
    assert sorted(tuple(r) for r in rows) == [("p", "d", ""), ("q", "e", "t")]


def test_visits_are_parsed_once_and_attributes_stay_with_their_visitor(spark):
    text = '<visits>\n  |<visitor id="1" sex="M" />\n  |<visitor age="30" sex="F" id=" 2" />\n|</visits>'
    rows = spark.createDataFrame([("c", 1, "row-1", text), ("c", 2, "row-2", "<visits></visits>")], "county string, sid bigint, id string, visitors string")
    out = jobs.visits(rows)
    assert sorted(map(tuple, out.select("visitor_id", "visitor_sex", "visitor_age").collect())) == [(" 2", "F", 30), ("1", "M", None)]
    assert "xpath" not in out._jdf.queryExecution().optimizedPlan().toString()
