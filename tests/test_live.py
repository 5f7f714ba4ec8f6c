"""Streaming jobs through restarts, repeated batches and faults; search, sketches, layouts, lineage."""

import bisect
import datetime as dt
import math
import random
import tempfile
import time
from collections import Counter
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.functions import runs
from millrace.ml import search
from millrace.operators import observed, sketches
from millrace.operators.ranking import cut_points, slot_of
from millrace.plans import governance, live
from millrace.sinks import clustered
from millrace.sources import numbered
from millrace.streaming import appends, delivery, multiset


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def drain(query):
    query.awaitTermination()
    assert query.exception() is None


# ---- multisets ---------------------------------------------------------------

EVENTS = "key string, value bigint, at bigint, step int"


def plain_multisets(rows):
    counts = {}
    for key, value, _, step in rows:
        counts[key, value] = max(counts.get((key, value), 0) + step, 0)
    left = {k: n for k, n in counts.items() if n}
    medians = {}
    for key in {k for k, _ in left}:
        values = sorted(v for (k, v), n in left.items() if k == key for _ in range(n))
        medians[key] = (len(values), values[(len(values) - 1) // 2])
    return left, medians


class FakeState(dict):
    """A map state that counts its updates."""
    updates = 0

    def getValue(self, key):
        return self[key]

    containsKey = dict.__contains__

    def updateValue(self, key, value):
        self.updates += 1
        self[key] = value

    def removeKey(self, key):
        del self[key]

    def iterator(self):
        return iter(self.items())


def test_events_of_a_slot_are_folded_as_batches():
    # a hot value is one state update a batch, however many events it has and however they are dealt
    counts = multiset.Counts()
    counts.counts = FakeState({(3,): (1,), (4,): (2,)})
    rows = pd.DataFrame([(3, i, -1 if i % 3 == 0 else 1) for i in range(5000)] + [(4, 5000 + i, -1) for i in range(5)], columns=["value", "at", "step"]).sample(frac=1, random_state=7)
    out = list(counts.handleInputRows(("a", 0), iter([rows[:2000], rows[2000:]]), None))[0]
    n = 1
    for i in range(5000):
        n = max(n + (-1 if i % 3 == 0 else 1), 0)
    assert out["counts"][0] == [{"value": 3, "n": n}] and out["size"][0] == n and counts.counts.updates == 1


def test_null_values_do_not_stop_the_stream(spark, folder):
    spark.createDataFrame([("a", None, i, 1) for i in range(3)] + [("a", 1, 3, 1)], EVENTS).write.parquet(folder + "/in")
    drain(multiset.start_multisets(spark.readStream.schema(EVENTS).parquet(folder + "/in"), folder + "/out", folder + "/check"))
    assert {(r.key, r.value): r.n for r in multiset.current(spark, folder + "/out", 0).collect()}[("a", 1)] == 1


@pytest.mark.parametrize("batches", [1, 4])
def test_multisets_equal_a_plain_fold_after_every_restart(spark, folder, batches):
    rng = random.Random(7)
    rows = [(rng.choice("abc"), rng.randint(-9, 60), i, rng.choice([1, 1, -1])) for i in range(400)]
    rows += [("gone", 5, 400, 1), ("gone", 5, 401, -1), ("gone", 5, 402, -1)]
    size = -(-len(rows) // batches)
    for i in range(0, len(rows), size):
        spark.createDataFrame(rows[i:i + size], EVENTS).write.mode("append").parquet(folder + "/in")
        drain(multiset.start_multisets(spark.readStream.schema(EVENTS).parquet(folder + "/in"), folder + "/out", folder + "/check", width=7))
        left, medians = plain_multisets(rows[:i + size])
        last = multiset.last_batch(spark, folder + "/out")
        assert {(r.key, r.value): r.n for r in multiset.current(spark, folder + "/out", last).collect()} == left
        written = spark.read.parquet(f"{folder}/out/medians/batch={last}").collect()
        assert {r.key: (r["size"], r.median) for r in written} == medians


# ---- metrics beside a write ---------------------------------------------------

LINES = ["a bb  ccc", "", "   ", "dd", "it's"]


def test_metrics_come_from_the_pass_that_writes(spark, folder):
    spark.createDataFrame([(x,) for x in LINES], "line string").write.parquet(folder + "/in")
    lines = spark.read.parquet(folder + "/in")
    scans = []
    seen = observed.write_observed(observed.word_rows(lines), lambda df: scans.append(counted := observed.counted_words(df)) or counted, observed.word_metrics(), folder + "/out")
    assert seen == {"words": 5, "word_lengths": 12, "min_len": 1, "max_len": 4, "empty_lines": 2}
    assert scans[0]._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 1
    assert {r.word: r.n for r in spark.read.parquet(folder + "/out").collect()} == {w: 1 for w in ("a", "bb", "ccc", "dd", "it's")}


def test_metrics_of_batches_add_up(spark, folder):
    for x in LINES:
        spark.createDataFrame([(x,)], "line string").write.mode("append").parquet(folder + "/in")
        drain(observed.start_observed(spark.readStream.schema("line string").parquet(folder + "/in"), folder + "/out", folder + "/check"))
    one = observed.summed(spark.read.parquet(folder + "/out/metrics").drop("batch")).first()
    assert tuple(one) == (5, 12, 1, 4, 2, 12 / 5)


# ---- numbered source -----------------------------------------------------------

def test_numbers_come_once_through_a_restart(spark, folder):
    def start():
        return (numbered.numbered_stream(spark, rows=70, last=999, first=3).writeStream.format("parquet").option("path", folder + "/out")
                .option("checkpointLocation", folder + "/check").start())

    q = start()
    while q.lastProgress is None or q.lastProgress["batchId"] < 3:
        time.sleep(0.05)
    q.stop()
    q = start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.num for r in spark.read.parquet(folder + "/out").collect()) == list(range(3, 1000))


def test_a_range_of_offsets_reads_the_same_rows_again():
    reader = numbered.NumberedReader({"rows": "10", "parts": "3"})
    assert reader.latestOffset() == {"next": 10} and reader.latestOffset() == {"next": 20}
    read = lambda: [x for p in reader.partitions({"next": 5}, {"next": 20}) for b in reader.read(p) for x in b.column(0).to_pylist()]
    assert read() == read() == list(range(5, 20))
    again = numbered.NumberedReader({"rows": "10"})
    again.partitions({"next": 40}, {"next": 40})
    assert again.latestOffset() == {"next": 50}


# ---- ledger ---------------------------------------------------------------------

def test_offsets_go_on_from_the_ledger_only(spark, folder):
    batch = spark.range(10)
    appends.append_batch(batch, 0, folder)
    appends.append_batch(spark.range(4), 1, folder)
    spark.range(99).write.mode("overwrite").parquet(folder + "/rows/batch=0")  # earlier rows are not looked at
    appends.append_batch(spark.range(7), 2, folder)
    assert [tuple(r) for r in appends.ledger(spark, folder).orderBy("batch").collect()] == [(0, 0, 10), (1, 10, 14), (2, 14, 21)]
    with pytest.raises(ValueError):
        appends.append_batch(batch, 9, folder)


def test_a_crash_between_rows_and_ledger_leaves_offsets_contiguous(spark, folder):
    appends.append_batch(spark.range(10), 0, folder)
    spark.range(3).withColumn("row_offset", F.col("id") + 10).write.parquet(folder + "/rows/batch=1")  # no line in the ledger
    assert appends.committed(spark, folder).count() == 10
    appends.append_batch(spark.range(5), 1, folder)
    assert sorted(r.row_offset for r in appends.committed(spark, folder).collect()) == list(range(15))


# ---- delivery --------------------------------------------------------------------

def letters(spark, keys):
    rows = [(bytearray(str(k), "utf-8"), {"uid": str(k)} if k is not None else {}, dt.datetime(2024, 1, 1)) for k in keys]
    return spark.createDataFrame(rows, delivery.DEAD)


def planted(rows, attempt):
    n = F.expr("try_cast(attributes['uid'] as int)")
    reason = F.when(n.isNull(), "bad key").when((n % 5 == 0) & F.lit(attempt <= 2), "timeout").when((n % 7 == 0), "unavailable")
    return rows.withColumn("reason", reason)


def landed(spark, out):
    return Counter(bytes(r.data).decode() for r in spark.read.parquet(out + "/rows").collect())


def test_every_row_lands_once_or_is_a_dead_letter(spark, folder):
    keys = [*range(1, 30), "x", None]
    delivery.deliver_batch(letters(spark, keys), 0, planted, folder, attempts=3, wait=0.0, valid=F.col("attributes")["uid"].isNotNull())
    dead = {bytes(r.data).decode(): (r.attributes["reason"], r.attributes["attempts"]) for r in spark.read.parquet(folder + "/dead_letters").collect()}
    assert dead == {**{str(k): ("unavailable", "3") for k in (7, 14, 21, 28)}, "x": ("bad key", "1"), "None": ("invalid", "0")}
    assert landed(spark, folder) == Counter(str(k) for k in range(1, 30) if k % 7)


def test_a_repeated_batch_does_not_send_again_what_has_landed(spark, folder):
    sent = []

    def broken(rows, attempt):
        sent.append((attempt, rows.count()))
        if attempt == 2 and len(sent) == 2:
            raise RuntimeError("the job died between two attempts")
        return planted(rows, attempt)

    batch = letters(spark, range(1, 30))
    with pytest.raises(RuntimeError):
        delivery.deliver_batch(batch, 0, broken, folder, wait=0.0)
    delivery.deliver_batch(batch, 0, broken, folder, wait=0.0)
    assert [a for a, _ in sent] == [1, 2, 2, 3] and sent[0][1] == 29 and sent[1] == sent[2]
    assert landed(spark, folder) == Counter(str(k) for k in range(1, 30) if k % 7)


def test_only_passing_errors_are_tried_again():
    waits, calls = [], []

    def action():
        calls.append(1)
        if len(calls) < 3:
            raise ConnectionError("gone for a moment")
        return "done"

    assert delivery.retried(action, wait=1, sleep=waits.append) == "done" and waits == [1, 2]
    with pytest.raises(ValueError):
        delivery.retried(lambda: (_ for _ in ()).throw(ValueError("wrong row")), sleep=waits.append)
    with pytest.raises(TimeoutError):
        delivery.retried(lambda: (_ for _ in ()).throw(TimeoutError()), attempts=2, sleep=waits.append)
    assert waits == [1, 2, 1.0]
    assert not delivery.passes(AnalysisException("no such column"))


# ---- search ------------------------------------------------------------------------

SPACE = {"x": search.Range(-2.0, 2.0), "y": search.Range(0.001, 1.0, log=True), "n": search.Range(1, 9, whole=True)}


def bowl(p):
    return -(p["x"] - 0.7) ** 2 - (math.log10(p["y"]) + 1.5) ** 2 - 0.05 * (p["n"] - 4) ** 2


def test_ranges_turn_both_ways():
    for r in SPACE.values():
        for u in (0.0, 0.2, 0.5, 0.99):
            assert r.value(r.unit(r.value(u))) == pytest.approx(r.value(u))
    assert Counter(SPACE["n"].value(i / 900) for i in range(900)) == {k: 100 for k in range(1, 10)}


def test_densities_are_those_of_the_formula():
    points = [0.1, 0.15, 0.6, 0.95]
    model = search.Parzen.of(points)
    widths = [max(0.1, 0.05), max(0.05, 0.45), max(0.45, 0.35), max(0.35, 0.05)]
    widths = [max(w, 1 / 6) / 4 for w in widths]

    def plain(x):
        phi = lambda z: (1 + math.erf(z / math.sqrt(2))) / 2
        kernels = [math.exp(-((x - p) / w) ** 2 / 2) / math.sqrt(2 * math.pi) / w / (phi((1 - p) / w) - phi(-p / w)) for p, w in zip(points, widths)]
        return (1 + sum(kernels)) / 5

    grid = [(i + 0.5) / 2000 for i in range(2000)]
    assert all(model.density(x) == pytest.approx(plain(x)) for x in grid[::40])
    assert sum(map(model.density, grid)) / 2000 == pytest.approx(1, abs=1e-3)


def test_proposals_are_the_draws_of_the_best_ratio():
    rng = random.Random(1)
    trials = [search.Trial(p, bowl(p)) for p in search.random_points(SPACE, 20, rng)]
    got = search.proposed(SPACE, trials, 3, random.Random(5), draws=6)
    ranked = sorted(trials, key=lambda t: -t.score)
    again, want = random.Random(5), []
    for _ in range(3):
        point = {}
        for name, r in SPACE.items():
            good, rest = [search.Parzen.of([r.unit(t.point[name]) for t in part]) for part in (ranked[:3], ranked[3:])]
            draws = [good.draw(again) for _ in range(6)]
            ratios = [good.density(d) / rest.density(d) for d in draws]
            point[name] = r.value(draws[ratios.index(max(ratios))])
        want.append(point)
    assert got == want


def test_forty_proposed_trials_are_better_than_forty_random_ones():
    wins = 0
    for seed in range(20):
        rng = random.Random(seed * 77 + 5)
        x, y, n = rng.uniform(-2, 2), rng.uniform(-3, 0), rng.randint(1, 9)
        valley = lambda p: -(p["x"] - x) ** 2 - (math.log10(p["y"]) - y) ** 2 - 0.05 * (p["n"] - n) ** 2  # noqa: B023, E731
        wins += search.best(search.sequential(valley, SPACE, 40, seed=seed)).score >= search.best(search.at_random(valley, SPACE, 40, seed=seed)).score
    assert wins >= 17


# ---- ranks, sketches, layout ----------------------------------------------------------

@pytest.mark.parametrize("kind", [int, float])
def test_slots_are_numbers_of_cut_points_below(spark, kind):
    rng = random.Random(3)
    for n in (1, 2, 7, 8, 1000):
        cuts = sorted({kind(rng.randint(0, 5000)) / (3 if kind is float else 1) if kind is float else rng.randint(0, 5000) for _ in range(n)})
        values = [kind(rng.randint(-5, 5005)) for _ in range(100)] + cuts[:100] + [None]
        df = spark.createDataFrame([(v,) for v in values], "v bigint" if kind is int else "v double")
        assert [r[0] for r in df.select(slot_of(F.col("v"), cuts)).collect()] == [None if v is None else bisect.bisect_left(cuts, v) for v in values]


def test_sketches_of_any_files_merge_within_the_bound(spark, folder):
    spark.range(30_000).select((F.rand(5) ** 3).alias("x"), (F.col("id") % 6).alias("f")).write.partitionBy("f").parquet(folder + "/in")
    table = spark.read.parquet(folder + "/in")
    sketches.store_sketches(table, F.col("x"), folder + "/sketches")
    spark.createDataFrame([(float(i), 9) for i in range(1000)], "x double, f bigint").write.mode("append").partitionBy("f").parquet(folder + "/in")
    table = spark.read.parquet(folder + "/in")
    sketches.store_sketches(table, F.col("x"), folder + "/sketches")  # only the new file is read
    stored = spark.read.parquet(folder + "/sketches")
    assert stored.agg(F.sum("n")).first()[0] == 31_000 and stored.select("file").distinct().count() == stored.count()
    for span, rows in ((stored, table), (stored.where("file like '%f=3%' or file like '%f=9%'"), table.where("f in (3, 9)"))):
        found = sketches.sketched_percentiles(span, [0.01, 0.5, 0.9, 0.999])
        assert all(r.gap <= sketches.rank_error() for r in sketches.rank_gap(rows, F.col("x"), found).collect())
    assert sketches.sketched_percentiles(stored.limit(0), [0.5]).collect() == []


def test_curve_visits_touching_cells(spark):
    grid = spark.range(256).select((F.col("id") % 16).alias("x"), F.floor(F.col("id") / 16).alias("y"))
    cells = sorted((r[2], r[0], r[1]) for r in grid.select("x", "y", clustered.along_curve(F.col("x"), F.col("y"), 4)).collect())
    assert [c[0] for c in cells] == list(range(256))
    assert all(abs(a[1] - b[1]) + abs(a[2] - b[2]) == 1 for a, b in zip(cells, cells[1:]))
    assert sorted(r[0] for r in grid.select(clustered.interleaved([F.col("x"), F.col("y")], 4)).collect()) == list(range(256))


def test_clustered_files_serve_three_columns(spark, folder):
    df = spark.range(20_000).select("id", *[F.rand(i).alias(c) for i, c in enumerate("abc")])
    clustered.write_clustered(df, ["a", "b", "c"], 64, folder + "/t")
    stored = spark.read.parquet(folder + "/t")
    assert stored.count() == 20_000
    for c in "abc":
        r = clustered.files_that_may_hold(stored, c, 0.40, 0.45).first()
        assert r["files"] == 64 and r["read"] <= 32
    assert len(cut_points(df, "a", 8)) == 7


# ---- runs -----------------------------------------------------------------------------

def test_runs_equal_a_plain_loop(spark):
    rng = random.Random(2)
    rows = [(u, dt.date(2024, 1, 1 + u % 2), rng.choice("xy"), i, float(rng.randint(0, 4000))) for i, u in enumerate(rng.choices(range(5), k=300))]
    want = []
    for key in {(r[0], r[1]) for r in rows}:
        run = None
        for _, _, kind, event, at in sorted((r for r in rows if (r[0], r[1]) == key), key=lambda r: (r[4], r[3])):
            if run and run[0] == kind and (len(run[1]) == 1 or at - run[1][-1][1] <= 3 * (run[1][-1][1] - run[1][0][1]) / (len(run[1]) - 1)):
                run[1].append((event, at))
            else:
                run = (kind, [(event, at)])
                want.append((key[0], run))
    want = sorted((u, k, es[0][0], es[-1][0], len(es), (es[-1][1] - es[0][1]) / (len(es) - 1) if len(es) > 1 else -1) for u, (k, es) in want)
    df = spark.createDataFrame(rows, "user_id bigint, day date, event_type string, event_id bigint, at double")
    got = sorted((r.user_id, r.event_type, r.first_event, r.last_event, r.events, -1 if r.gap_seconds is None else r.gap_seconds) for r in runs.event_runs(df).collect())
    assert got == want
    assert runs.event_runs(df.limit(0)).collect() == []


# ---- lineage ---------------------------------------------------------------------------

POLICY = [governance.Policy("a", "secret", ("auditor",), ("analyst",))]


def use(df, table):
    shown, used = governance.mask_use(df, table, "a", POLICY, "analyst")
    return sorted(shown), sorted(used)


def test_lineage_follows_columns_not_names(spark):
    a = spark.createDataFrame([(1, 2, [3])], "k int, secret int, xs array<int>")
    b = spark.createDataFrame([(1, 5)], "k int, secret int")
    assert use(a.select("secret"), a) == (["secret"], []) and use(b.select("secret"), a) == ([], [])
    assert use(a.join(b, "k").select(b.secret), a) == ([], []) and use(a.join(b, "k").select(a.secret), a) == (["secret"], [])
    assert use(a.join(b, a.secret == b.secret).select(b.k), a) == ([], ["secret"])
    assert use(a.rollup("k").agg(F.sum("secret").alias("s")), a) == (["s"], [])
    assert use(a.groupBy("secret").count().select("count"), a) == ([], ["secret"])
    assert use(a.select("k", F.explode(F.array("secret", "k")).alias("x")), a) == (["x"], [])
    assert use(a.select("k", F.explode("xs").alias("x")), a) == ([], [])
    assert use(a.withColumn("z", F.col("secret") + 1).drop("z", "secret"), a) == ([], [])
    assert use(a.select("k").union(a.select("secret")), a) == (["k"], [])
    assert use(a.orderBy("secret").select("k"), a) == ([], ["secret"])
    assert use(a.select("k").intersect(a.select("secret")), a) == (["k"], ["secret"])
    twice = F.udf(lambda x: 2 * x, "int")
    assert use(a.select(twice("secret").alias("t"), "k"), a) == (["t"], [])
    assert use(a.select("k", "secret").mapInPandas(lambda frames: frames, "m int, n int"), a) == (["m", "n"], [])
    one, two = a.alias("one"), a.alias("two")
    assert use(one.join(two, F.col("one.k") == F.col("two.k")).select(F.col("two.secret").alias("s")), a) == (["s"], [])


def test_rows_of_a_batch_are_dealt_to_all_cores(spark):
    # a table in order of its time: a stretch of it stands in one task
    rows = spark.range(0, 8000, 1, 1).toDF("event_id")
    path = live.fed(SimpleNamespace(spark=spark), rows, F.col("event_id"), "dealt", lambda events, path: [], batches=2)
    files = spark.read.parquet(path + "/in").groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"))
    sizes = [r["n"] for r in files.collect()]
    assert sum(sizes) == 8000 and len(sizes) == 2 * spark.sparkContext.defaultParallelism and max(sizes) < 1000
