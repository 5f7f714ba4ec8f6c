"""Event and JSON analytics: the test-group funnel, visits, seats and scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.functions import text
from millrace.functions.money import half_up, total
from millrace.operators.eventlog import lower_median, surviving
from millrace.operators.relational import leading, match
from millrace.registry import Tables, query
from millrace.session import scratch
from millrace.sinks.writes import replace_day
from millrace.sources import files

col = F.col


# ---- test-group funnel -----------------------------------------------------

# click names that count as interaction (fixed values)
CLICKS = ("post_head_click", "post_content_click", "post_more_click", "post_share_click", "post_comment_click",
          "post_good_click", "post_tag_click", "post_hot_comment_click")


def funnel_users(events: DataFrame, groups: DataFrame, profiles: DataFrame, event_id: str, day: str) -> DataFrame:
    """One row per exposed user and test group with what the user saw and clicked.

    ``events``: uid, eventid, dt, moreinfo (JSON text).
    """
    def field(name: str) -> Column:
        return F.get_json_object("moreinfo", f"$.{name}")

    mine = events.where((col("eventid") == event_id) & (col("dt") == day) & (col("uid") > 0)).select(
        "uid", field("function_id").alias("function_id"), field("subject_id").alias("subject_id"),
        field("tag_id").alias("label_id"), field("post_id").alias("post_id"))
    shown = (mine.where("function_id = 'post_content_show'").groupBy("post_id", "label_id", "subject_id", "uid")
             .agg(F.count("*").alias("cnt")).groupBy("uid")
             .agg(F.count("post_id").alias("show_post_num"), F.sum("cnt").alias("show_cnt")))
    clicked = mine.where(col("function_id").isin(*CLICKS)).groupBy(col("uid").alias("k")).agg(
        F.count(F.when(col("function_id") == "post_more_click", col("post_id"))).alias("click_cost_pv"),
        F.count("post_id").alias("click_pv"))
    tests = groups.where(col("dt") == day).drop("dt").withColumnRenamed("uid", "test_uid")
    people = profiles.where(col("dt") == day).drop("dt").withColumnRenamed("uid", "profile_uid")
    s = match(shown, clicked, "left", uid="k")
    s = match(match(s, tests, uid="test_uid"), people, uid="profile_uid")
    zero = F.lit(0)
    return s.select("uid", "abtest_report_type", "abtest", "abgroup", "test_type", "control_group", "nation", "ver",
                    col("is_new_user").cast("string").alias("is_new_user"), "appkey", F.lit(1).alias("is_post_show"),
                    "show_post_num", "show_cnt", F.coalesce("click_cost_pv", zero).alias("click_cost_pv"),
                    F.coalesce("click_pv", zero).alias("click_pv"))


# profile columns that also count under 'all', and the measures added up (fixed values)
ALL_KEYS = ("nation", "ver", "is_new_user", "appkey")
MEASURES = ("is_post_show", "show_post_num", "show_cnt", "click_cost_pv", "click_pv")


def funnel_cube(users: DataFrame) -> DataFrame:
    """Totals per test group for every profile combination, each key also as ``all``.

    Users are first added up per exact combination, so the sixteen copies of
    the cube are made of groups and not of users.
    """
    tests = ["abtest_report_type", "abtest", "abgroup", "test_type", "control_group"]
    base = users.groupBy(*tests, *ALL_KEYS).agg(F.count("uid").alias("users"), *[F.sum(m).alias(m) for m in MEASURES])
    for key in ALL_KEYS:
        base = base.withColumn(key, F.explode(F.array(col(key), F.lit("all"))))
    labels = [F.coalesce(k, F.lit("all")).alias(k) for k in ALL_KEYS]
    return base.groupBy(*tests, *labels).agg(F.sum("users").alias("users"), *[F.sum(m).alias(m) for m in MEASURES])


def test_events(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Protocol events, test groups and profiles made from the event and customer tables."""
    k = F.get_json_object("props", "$.k").cast("int")
    name = F.when(col("event_type") == "view", "post_content_show").when(k % 2 == 0, "post_more_click").otherwise("post_tag_click")
    info = F.to_json(F.struct(name.alias("function_id"), (k % 5).cast("string").alias("subject_id"),
                              (k % 3).cast("string").alias("tag_id"), k.cast("string").alias("post_id")))
    e = t.events.select(col("user_id").alias("uid"), F.lit("1001").alias("eventid"),
                        F.lit("20240105").alias("dt"), info.alias("moreinfo"))
    c = t.customer.select(col("c_custkey").alias("uid"), F.lit("20240105").alias("dt"), "*")
    tests = c.select("uid", F.concat(F.lit("test"), col("c_custkey") % 2).alias("abtest"),
                     F.concat(F.lit("group"), col("c_custkey") % 3).alias("abgroup"), F.lit("daily").alias("abtest_report_type"),
                     F.lit("post").alias("test_type"), (col("c_custkey") % 3 == 0).cast("string").alias("control_group"), "dt")
    people = c.select("uid", F.when(col("c_custkey") % 11 != 0, F.concat(F.lit("n"), col("c_nationkey") % 4)).alias("nation"),
                      F.concat(F.lit("v"), col("c_custkey") % 2).alias("ver"), (col("c_custkey") % 2).alias("is_new_user"),
                      col("c_mktsegment").alias("appkey"), "dt")
    return e, tests, people


@query
def m13_test_funnel(t: Tables):
    """The whole funnel, written for its day and read back."""
    events, tests, people = test_events(t)
    cube = funnel_cube(funnel_users(events, tests, people, "1001", "20240105"))
    path = scratch(t.spark, "funnel")
    replace_day(cube, path, "20240105")
    out = t.spark.read.parquet(path)
    return out.drop("dt", "abtest_report_type", "test_type", "control_group")


@query
def f11_json_fields(t: Tables):
    return t.events.groupBy(F.get_json_object("props", "$.k").cast("int").alias("k")).agg(F.count("*").alias("n"))


# ---- visits in XML text ----------------------------------------------------

def visits(rows: DataFrame) -> DataFrame:
    """One row per visitor named in the margin-marked XML text of a visit row."""
    # a text that is no XML stops the job
    read = F.from_xml(text.strip_margin(col("visitors")), "visitor array<struct<_id string, _sex string, _age string>>", {"mode": "FAILFAST", "ignoreSurroundingSpaces": "false"})
    one = rows.withColumn("visitor", F.explode(read["visitor"]))
    return one.select("county", "sid", "id", F.col("visitor._id").alias("visitor_id"),
                      F.col("visitor._sex").alias("visitor_sex"), F.col("visitor._age").cast("int").alias("visitor_age"))


def visit_rows(t: Tables) -> DataFrame:
    """JSON lines with visitors as XML, written from the events and read back."""
    k = F.get_json_object("props", "$.k").cast("int")
    e = t.events.withColumn("who", F.sequence(F.lit(1), k % 4 + 1))
    tag = F.transform("who", lambda i: F.concat(
        F.lit('\n      |<visitor id="'), i.cast("string"), F.lit('" age="'),
        (F.lit(20) + (col("event_id") * 7 + i * 13) % 60).cast("string"), F.lit('" sex="'),
        F.when(i % 2 == 0, "F").otherwise("M"), F.lit('" />')))
    xml = F.concat(F.lit("<visits>"), F.array_join(tag, ""), F.lit("\n   |</visits>"))
    path = scratch(t.spark, "visits")
    e.select(F.concat(F.lit("county "), col("user_id") % 10).alias("county"), col("event_id").alias("sid"),
             F.concat(F.lit("row-"), col("event_id")).alias("id"), xml.alias("visitors")).write.json(path)
    return visits(files.json_lines(t.spark, path))


@query
def f14_f15_visits(t: Tables):
    return visit_rows(t).groupBy("county", "visitor_sex").agg(F.count("*").alias("n"), F.sum("visitor_age").alias("ages"))


@query
def g11_visitors_per_birth(t: Tables):
    """County with the most visitors per birth, by averaging and by a ratio of totals."""
    per = visit_rows(t).groupBy("county", "sid").agg(F.count("*").alias("n"))
    both = per.groupBy("county").agg(F.avg("n").alias("by_mean"), (F.sum("n") / F.count("*")).alias("by_ratio"))
    return leading(both, "-by_mean", "county", n=1)


@query
def g11_mean_visitor_age(t: Tables):
    per = visit_rows(t).where("county = 'county 3'").groupBy("sid").agg(F.avg("visitor_age").alias("a"))
    return per.agg(F.round(F.avg("a"), 8).alias("mean_age"))


@query
def g13_common_age(t: Tables):
    ages = visit_rows(t).where("county = 'county 3'").groupBy("visitor_age").agg(F.count("*").alias("n"))
    return leading(ages, "-n", "visitor_age", n=1)


# ---- seats and multisets ---------------------------------------------------

def seat_requests(requests: DataFrame) -> DataFrame:
    """Per seat the earliest requester, with that person's first id and highest request."""
    per = requests.groupBy("seat_no", "person_id").agg(F.min("request_id").alias("request_id"), F.max("request").alias("request"))
    # the least struct per seat is the earliest request; no window needed
    first = per.groupBy(col("seat_no").alias("r_seat")).agg(F.min(F.struct("request_id", "request", "person_id")).alias("r"))
    return first.select("r_seat", col("r.request").alias("r_request"), col("r.person_id").alias("r_person"))


def allocate(seats: DataFrame, requests: DataFrame) -> DataFrame:
    """Seat state after the first request: 1 reserved, 2 sold, a holder may buy."""
    s = match(seats, seat_requests(requests), "left", seat_no="r_seat")
    free = (col("status") == 0) & col("r_request").isin(1, 2)
    upgrade = (col("status") == 1) & (col("r_request") == 2) & (col("person_id") == col("r_person"))
    return s.select("seat_no", F.when(free, col("r_request")).when(upgrade, F.lit(2)).otherwise(col("status")).alias("status"),
                    F.when(free | upgrade, col("r_person")).otherwise(col("person_id")).alias("person_id"))


@query
def m14_seat_allocation(t: Tables):
    """Parts are seats, order lines are requests."""
    seats = t.part.select(col("p_partkey").alias("seat_no"), (col("p_partkey") % 3).cast("int").alias("status"),
                          F.when(col("p_partkey") % 3 > 0, col("p_partkey") % 50).alias("person_id"))
    requests = t.lineitem.select(
        (col("l_orderkey") * 10 + col("l_linenumber")).alias("request_id"), (1 + col("l_linenumber") % 2).alias("request"),
        col("l_partkey").alias("seat_no"), (col("l_suppkey") % 50).alias("person_id"))
    return allocate(seats, requests)


def changes(t: Tables) -> DataFrame:
    """Events as additions and deletions of a small number per event type."""
    return t.events.select("event_type", "event_id", F.get_json_object("props", "$.k").cast("int").alias("k"),
                           F.when(col("event_id") % 3 == 0, -1).otherwise(1).alias("step"))


@query
def g20_multiset(t: Tables):
    return surviving(changes(t), ["event_type"], "k", "event_id", "step")


@query
def g20_multiset_median(t: Tables):
    return lower_median(surviving(changes(t), ["event_type"], "k", "event_id", "step"), ["event_type"], "k")


# ---- scalar functions ------------------------------------------------------

@query
def f1_to_f4_text_and_casts(t: Tables):
    return t.customer.select(
        "c_custkey", F.substring("c_name", 1, 8).alias("prefix"),
        F.concat(F.coalesce(F.when(col("c_custkey") % 5 != 0, col("c_mktsegment")), F.lit("")), F.lit("/"),
                 col("c_custkey").cast("string")).alias("label"),
        F.upper(F.substring("c_mktsegment", 1, 3)).alias("seg"), col("c_acctbal").cast("double").alias("bal"),
        F.lit("1999-4-01").cast("date").alias("day"))


@query
def f5_f6_dates(t: Tables):
    day = F.to_date("o_orderdate")
    return t.orders.select("o_orderkey", F.date_add(day, 14).alias("later"), F.date_sub(day, 30).alias("earlier"),
                           F.datediff(F.lit("1999-01-01").cast("date"), day).alias("days"))


@query
def f7_f8_times(t: Tables):
    start = F.timestamp_seconds(F.lit(1721975644.050687) + col("event_id"))
    end = F.timestamp_seconds(F.lit(1721975644.050687) + col("event_id") + col("value"))
    ms = F.timestamp_diff("MILLISECOND", start, end)
    return t.events.select("event_id", F.date_format(F.timestamp_seconds(1721975644 + col("event_id")), "yyyy-MM-dd HH:mm:ss").alias("started"),
                           (ms >= 0).alias("ordered"), F.when(col("value") > 0, half_up(col("event_id") * 10 / col("value"), 4)).alias("slots"))


@query
def f9_f10_numbers(t: Tables):
    return t.customer.select("c_custkey", F.coalesce(F.when(col("c_custkey") % 3 != 0, col("c_acctbal")), F.lit(0.0)).alias("bal"),
                             F.abs("c_acctbal").alias("size"), F.round("c_acctbal", 0).alias("whole"))


@query
def f12_words(t: Tables):
    return t.conversations.select("conv_id", "turn", F.size(text.words(col("text"))).alias("words"),
                                  F.size(text.words(col("text"), True)).alias("with_apostrophes"))


@query
def f16_arrays(t: Tables):
    e = t.embeddings.select("vec_id", F.get("embedding", F.lit(0)).alias("first"), F.size("embedding").alias("dims"))
    return e.select("vec_id", "first", "dims", F.explode(F.array(F.lit("a"), F.lit("all"))).alias("side"))


@query
def f17_empty_for_null(t: Tables):
    odd = col("c_custkey") % 2 == 1
    listed = text.empty_list_if_null(F.when(odd, F.array("c_mktsegment")), "string")
    return t.customer.select("c_custkey", text.empty_if_null(F.when(odd, col("c_name"))).alias("name"), F.size(listed).alias("n"))


@query
def f18_nested_message(t: Tables):
    """A struct of structs with repeated text, as JSON."""
    window = F.struct(F.date_format(col("o_orderdate").cast("timestamp"), "yyyy-MM-dd").alias("startTime"))
    asset = F.struct(F.array("o_orderstatus", "o_orderpriority").alias("ancestors"), F.lit("order").alias("assetType"))
    message = F.struct(asset.alias("asset"), F.lit("PRESENT").alias("priorAssetState"), window.alias("window"))
    return t.orders.select("o_orderkey", F.to_json(message).alias("message"))


@query
def f19_run_time(t: Tables):
    """Templates take the run time as an argument, so a run can be repeated."""
    t.orders.createOrReplaceTempView("run_orders")
    return t.spark.sql("select o_orderkey, date_add(:run_date, -1) as day_before from run_orders where o_orderdate < :run_date",
                       args={"run_date": dt.date(1996, 1, 1)})


@query
def f20_word_lines(t: Tables):
    n = t.events.groupBy("event_type").agg(F.count("*").alias("n"))
    return n.select(text.word_line(col("event_type"), col("n")).alias("line"))


@query
def f21_rounded_integers(t: Tables):
    return t.lineitem.select("l_orderkey", "l_partkey", text.rounded_int(col("l_quantity") / 2).alias("half_up"),
                             text.rounded_int(-col("l_quantity") / 2).alias("half_down"))


@query
def u1_scalar_function(t: Tables):
    """Margin stripping with built-in functions in place of a row-at-a-time function."""
    marked = F.regexp_replace("text", "\n", "\n   |")
    return t.documents.select("doc_id", (text.strip_margin(marked) == text.strip_margin(F.col("text"))).alias("same"),
                              F.length(text.strip_margin(marked)).alias("n"))


@query
def u2_rows_from_row(t: Tables):
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.groupBy("doc_id").agg(F.count("*").alias("lines"), F.max(F.length("line")).alias("longest"))


@query
def u3_filter_not_null_rows(t: Tables):
    """Rows of other events are dropped, not passed on as nulls."""
    return t.events.where("event_type = 'error'").select("user_id", F.to_json(F.struct("event_id", "event_type")).alias("data"))


@query
def u4_sum_of_ones(t: Tables):
    return t.events.select(col("event_type").alias("word"), F.lit(1).alias("one")).groupBy("word").agg(F.sum("one").alias("n"))
