"""Small hand-built and random inputs against brute force: nulls, ties, empties, hot keys."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.functions.money import half_up, mean, ratio, total
from millrace.operators import ranking
from millrace.operators.eventlog import lower_median, surviving
from millrace.operators.nesting import nested
from millrace.operators.relational import leading, match, union_all, with_group
from millrace.plans.jobs import allocate, funnel_cube


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(params=[2, 50], ids=["two ranges", "many ranges"])
def ranges(request, spark):
    """Run with few and with many ranges; there is one path for all sizes."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def sample(seed, n=400, hot=0.4):
    """Keyed integers where one key and one value hold a large share, with nulls."""
    rng = random.Random(seed)
    return [("hot" if rng.random() < hot else f"k{rng.randint(1, 6)}",
             5 if rng.random() < hot else rng.choice([None, rng.randint(-50, 50)])) for _ in range(n)]


def test_rank_against_brute_force(spark, ranges):
    data = [v for _, v in sample(1)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], "id int, v int")
    got = dict((r["id"], r["rk"]) for r in ranking.with_rank(df, "v", "rk").collect())
    known = [v for v in data if v is not None]
    assert got == {i: 1 + sum(x < v for x in known) for i, v in enumerate(data) if v is not None}
    down = dict((r["id"], r["rk"]) for r in ranking.with_rank(df, "v", "rk", descending=True).collect())
    assert down == {i: 1 + sum(x > v for x in known) for i, v in enumerate(data) if v is not None}


def test_rank_by_key_with_null_key(spark, ranges):
    data = [("a", 1), ("a", 1), ("a", 3), (None, 2), (None, 5), ("b", None)]
    df = spark.createDataFrame(data, "k string, v int")
    assert rows(ranking.with_rank(df, "v", "rk", ["k"])) == sorted(
        [("a", 1, 1), ("a", 1, 1), ("a", 3, 3), (None, 2, 1), (None, 5, 2)], key=str)


def test_first_ranks_keep_ties(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1, 1, 1, 2, 3, 3, 9])], "id int, v int")
    got = rows(ranking.first_ranks(df, "v", "rk", 4))
    assert [(r[0], r[2]) for r in got] == [(0, 1), (1, 1), (2, 1), (3, 4)]


@pytest.mark.parametrize("seed", [2, 3])
def test_percentiles_against_numpy(spark, ranges, seed):
    import numpy as np
    values = [v for _, v in sample(seed) if v is not None]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    shares = [0.0, 0.25, 0.5, 0.99, 0.999, 1.0]
    got = {r["share"]: r["value"] for r in ranking.percentiles(df, "v", shares).collect()}
    assert got == pytest.approx({s: float(np.percentile(values, s * 100)) for s in shares})


def test_lower_median_by_key(spark, ranges):
    data = sample(4)
    df = spark.createDataFrame(data, "k string, v int")
    got = {r["k"]: r["value"] for r in ranking.percentiles(df, "v", [0.5], ["k"], interpolate=False).collect()}
    want = {}
    for k in {k for k, _ in data}:
        known = sorted(v for x, v in data if x == k and v is not None)
        want[k] = known[(len(known) - 1) // 2]
    assert got == want


def test_slots_follow_the_cuts(spark):
    cuts = [1, 4, 4.5, 10, 30]
    df = spark.createDataFrame([(float(v),) for v in range(-1, 40)], "v double")
    for r in df.select("v", ranking.slot_of(F.col("v"), cuts).alias("s")).collect():
        assert r["s"] == sum(c < r["v"] for c in cuts)


@pytest.mark.parametrize("slices", [1, 7, 64])
def test_multiset_fold(spark, ranges, slices):
    rng = random.Random(5)
    events = [("x" if rng.random() < 0.5 else "y", rng.choice([1, 1, 1, 2, 3]), i, rng.choice([1, -1, -1])) for i in range(500)]
    held: dict = {}
    for k, v, _, step in events:
        held[k, v] = max(0, held.get((k, v), 0) + step)
    df = spark.createDataFrame(events, "k string, v int, at int, step int")
    left = surviving(df, ["k"], "v", "at", "step", slices)
    assert {(r["k"], r["v"]): r["n"] for r in left.collect()} == {kv: n for kv, n in held.items() if n}
    want = {}
    for k in ("x", "y"):
        bag = sorted(v for (kk, v), n in held.items() if kk == k for _ in range(n))
        if bag:
            want[k] = bag[(len(bag) - 1) // 2]
    assert {r["k"]: r["median"] for r in lower_median(left, ["k"], "v").collect()} == want


def test_nested_splits_by_a_rule_and_keeps_all(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 900, "hot").otherwise("cold").alias("k"), "id")
    out = nested(df, ["k"], F.struct("id"), "items", F.floor(F.col("id") / 100)).collect()
    assert sum(len(r["items"]) for r in out) == 1000
    assert sorted(r["part"] for r in out if r["k"] == "hot") == list(range(9))
    assert all([x["id"] for x in r["items"]] == sorted(x["id"] for x in r["items"]) for r in out)


def test_first_ranks_of_nothing(spark):
    assert ranking.first_ranks(spark.createDataFrame([(1, None)], "id int, v double"), "v", "rk", 3).collect() == []


def test_shared_folder(spark, monkeypatch, tmp_path):
    from millrace import session

    class Context:
        master, found = "spark://somewhere:7077", None

        def getCheckpointDir(self):
            return self.found

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(ValueError):
        session.shared_folder(Session)
    Session.sparkContext.found = "hdfs://shared/ckpt"
    assert session.scratch(Session, "x").startswith("hdfs://shared/ckpt/x-")


def test_group_totals_with_null_key(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), (None, None)], "k string, v double")
    assert rows(with_group(df, ["k"], total("v").alias("t"), mean("v").alias("m"))) == sorted(
        [("a", 1.0, 4.0, 2.0), ("a", 3.0, 4.0, 2.0), (None, 5.0, 5.0, 5.0), (None, None, 5.0, 5.0)], key=str)


def test_money(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,)], "v double")
    r = df.agg(total("v").alias("t"), mean("v").alias("m")).first()
    assert (r["t"], r["m"]) == (0.3, 0.15)
    assert df.where("v > 9").agg(mean("v").alias("m")).first()["m"] is None
    one = spark.range(1).select(half_up(F.lit(2.5), 0).alias("a"), half_up(F.lit(0.125), 2).alias("b"),
                                ratio(F.lit(1.0), F.lit(0.0)).alias("c")).first()
    assert tuple(one) == (3.0, 0.13, None)


def test_leading_orders_nulls(spark):
    df = spark.createDataFrame([(None, 1), (2, 2), (1, 3), (2, 1)], "a int, b int")
    assert [tuple(r) for r in leading(df, "a", "-b", n=3).collect()] == [(None, 1), (1, 3), (2, 2)]
    assert [tuple(r) for r in leading(df, "-a", n=3).collect()] == [(2, 1), (2, 2), (1, 3)]


def test_null_keys_do_not_match(spark):
    a = spark.createDataFrame([(1,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (None,)], "y int")
    assert match(a, b, x="y").count() == 1
    assert match(a, b, "left_anti", x="y").count() == 1


def test_seat_rules(spark):
    seats = spark.createDataFrame([(1, 0, None), (2, 0, None), (3, 1, 7), (4, 1, 7), (5, 2, 9), (6, 0, None)],
                                  "seat_no int, status int, person_id int")
    requests = spark.createDataFrame(
        [(10, 1, 1, 5), (11, 2, 1, 6), (12, 2, 2, 5), (13, 2, 3, 7), (14, 2, 4, 8), (15, 2, 5, 1)],
        "request_id int, request int, seat_no int, person_id int")
    assert rows(allocate(seats, requests)) == sorted(
        [(1, 1, 5), (2, 2, 5), (3, 2, 7), (4, 1, 7), (5, 2, 9), (6, 0, None)], key=str)


def test_cube_counts_null_keys_under_all(spark):
    user = dict(uid=1, abtest_report_type="d", abtest="t", abgroup="g", test_type="p", control_group="c", nation=None,
                ver="v", is_new_user="1", appkey="k", is_post_show=1, show_post_num=2, show_cnt=3, click_cost_pv=0, click_pv=1)
    schema = ("uid int, abtest_report_type string, abtest string, abgroup string, test_type string, control_group string, "
              "nation string, ver string, is_new_user string, appkey string, is_post_show int, show_post_num int, "
              "show_cnt int, click_cost_pv int, click_pv int")
    out = funnel_cube(spark.createDataFrame([user], schema)).collect()
    assert len(out) == 8 and {r["nation"] for r in out} == {"all"} and {r["users"] for r in out} == {2}


def test_places_of_cells_are_those_of_the_curve(spark):
    from millrace.sinks import clustered
    for bits in (1, 3, 6):
        side = 1 << bits
        cells = spark.range(side * side).select((F.col("id") / side).cast("int").alias("x"), (F.col("id") % side).cast("int").alias("y"))
        placed = cells.select(clustered.along_curve(F.col("x"), F.col("y"), bits).alias("a"), clustered.along_known_curve(F.col("x"), F.col("y"), bits).alias("b"))
        assert placed.where("a <> b or b is null").isEmpty() and placed.select("b").distinct().count() == side * side


def test_runs_of_many_users_and_days_share_a_call(spark):
    import pyarrow as pa

    from millrace.functions import runs
    rows = spark.createDataFrame([(u, d, "view", 100 * u + 10 * d + i, float(i)) for u in (1, 2) for d in range(3) for i in range(2)],
                                 "user_id bigint, day int, event_type string, event_id bigint, at double")
    out = sorted((r.user_id, r.first_event, r.last_event, r.events, r.gap_seconds) for r in runs.event_runs(rows).collect())
    assert out == [(u, 100 * u + 10 * d, 100 * u + 10 * d + 1, 2, 1.0) for u in (1, 2) for d in range(3)]
    # one call keeps the users and days of its rows apart
    call = runs.EventRuns.func()
    tables = [*call.eval(pa.RecordBatch.from_pylist([{"user_id": u, "day": d, "event_type": "view", "event_id": 10 * u + d, "at": 0.0} for u in (1, 2) for d in (1, 2)])), *call.terminate()]
    assert sum(t.num_rows for t in tables) == 4


def test_a_task_has_one_branch_of_a_union(spark):
    def joined(i):
        return spark.range(1000 * i, 1000 * i + 1000).withColumn("k", F.col("id") % 7).join(spark.range(7).toDF("k").hint("merge"), "k")

    branches = [joined(i) for i in range(3)]
    assert union_all(*branches).rdd.getNumPartitions() == sum(x.rdd.getNumPartitions() for x in branches)
