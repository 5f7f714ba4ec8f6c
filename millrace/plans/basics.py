"""One query per relational operator, on the raw order and event tables."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from millrace.functions import text
from millrace.functions.money import half_up, mean, ratio, total
from millrace.operators import sketches
from millrace.operators.nesting import nested
from millrace.operators.ranking import first_ranks, percentiles, with_rank
from millrace.operators.relational import leading, match, renamed, union_all, with_group
from millrace.registry import Tables, query
from millrace.session import scratch

col = F.col


def revenue():
    return half_up(col("l_extendedprice") * (1 - col("l_discount")), 2)


def order_day(t: Tables):
    return t.orders.withColumn("o_day", F.to_date("o_orderdate"))


# ---- projections and predicates -------------------------------------------

@query
def p1_projection(t: Tables):
    return t.lineitem.select("l_orderkey", col("l_linenumber").alias("line"), revenue().alias("revenue"),
                             (col("l_quantity") * 2).alias("double_qty"))


@query
def p2_conjunction(t: Tables):
    return t.lineitem.where("l_quantity < 24 and l_discount >= 0.05 and l_shipdate >= timestamp_ntz'1997-01-01'").select(
        "l_orderkey", "l_partkey", "l_quantity")


@query
def p3_or_of_ands(t: Tables):
    s = match(t.lineitem, t.part, l_partkey="p_partkey")
    small = (col("p_type") == "SMALL") & col("p_size").between(1, 15) & col("l_quantity").between(1, 11)
    large = (col("p_type") == "LARGE") & col("p_size").between(1, 40) & col("l_quantity").between(10, 30)
    return s.where(small | large).groupBy("p_type").agg(total(revenue()).alias("revenue"), F.count("*").alias("n"))


@query
def p4_between(t: Tables):
    return order_day(t).where(col("o_totalprice").between(1000 * 50, 1000 * 50 + 20000) & col("o_day").between(
        F.lit("1997-01-01").cast("date"), F.lit("1998-12-31").cast("date"))).select("o_orderkey", "o_totalprice", "o_day")


@query
def p5_in_list(t: Tables):
    return t.customer.where(col("c_mktsegment").isin("BUILDING", "HOUSEHOLD")).select("c_custkey", "c_mktsegment")


@query
def p6_null_tests(t: Tables):
    buyers = t.orders.where("o_totalprice > 300000").select(col("o_custkey").alias("buyer")).distinct()
    both = match(t.customer, buyers, "left", c_custkey="buyer")
    return both.agg(F.count_if(col("buyer").isNull()).alias("without"), F.count_if(col("buyer").isNotNull()).alias("with_large"))


@query
def p7_like(t: Tables):
    return t.part.where(col("p_name").like("small%") | col("p_name").like("%ring%")).select("p_partkey", "p_name")


@query
def p8_case(t: Tables):
    band = F.when(col("o_totalprice") < 50000, "low").when(col("o_totalprice") < 150000, "mid").otherwise("high")
    word = F.expr("case o_orderstatus when 'F' then 'final' when 'O' then 'open' else 'partial' end")
    return t.orders.groupBy(band.alias("band"), word.alias("status")).agg(F.count("*").alias("n"))


@query
def p9_guarded_ratio(t: Tables):
    s = t.lineitem.groupBy("l_suppkey").agg(
        F.count_if(col("l_returnflag") == "R").alias("returned"), F.count_if(col("l_returnflag") == "N").alias("kept"))
    return s.where(ratio("returned", "kept") > 0.6).withColumn("share", ratio("returned", "kept"))


@query
def p10_distinct(t: Tables):
    return t.part.select("p_brand", "p_type").distinct()


@query
def p11_flag(t: Tables):
    return t.orders.select("o_orderkey", F.when(col("o_totalprice") > 100000, 1).otherwise(0).alias("is_large"))


@query
def p12_scalar_subquery(t: Tables):
    typical = t.orders.agg(mean("o_totalprice").alias("m"))
    return t.orders.where(col("o_totalprice") > typical.scalar() * 1.5).select("o_orderkey", "o_totalprice")


@query
def p13_scalar_in_case(t: Tables):
    """Both branches of every band come from one pass."""
    bands = [(1, 10), (11, 30), (31, 50)]
    aggs = []
    for i, (lo, hi) in enumerate(bands):
        inside = col("l_quantity").between(lo, hi)
        aggs += [F.count_if(inside).alias(f"n{i}"), mean(F.when(inside, col("l_extendedprice"))).alias(f"a{i}"),
                 total(F.when(inside, col("l_tax"))).alias(f"b{i}")]
    return t.lineitem.agg(*aggs).select(*[
        F.when(col(f"n{i}") > 15000, col(f"a{i}")).otherwise(col(f"b{i}")).alias(f"band{i}") for i in range(len(bands))])


@query
def p14_correlated_mean(t: Tables):
    s = with_group(t.lineitem.select("l_orderkey", "l_partkey", "l_quantity"), ["l_partkey"],
                   F.avg("l_quantity").alias("m"))
    return s.where(col("l_quantity") < col("m") * 0.2).groupBy("l_partkey").agg(F.count("*").alias("n"))


# ---- joins -----------------------------------------------------------------

@query
def j1_star_join(t: Tables):
    s = match(match(t.lineitem, t.orders, l_orderkey="o_orderkey"), t.customer, o_custkey="c_custkey")
    s = match(match(s, t.nation, c_nationkey="n_nationkey"), t.region, n_regionkey="r_regionkey")
    return s.where("r_name = 'ASIA'").groupBy("n_name").agg(total(revenue()).alias("revenue"))


@query
def j2_inner_chain(t: Tables):
    s = match(match(t.supplier, t.nation, s_nationkey="n_nationkey"), t.region, n_regionkey="r_regionkey")
    return s.select("s_suppkey", "n_name", "r_name")


@query
def j3_left_composite(t: Tables):
    back = t.lineitem.where("l_returnflag = 'R'").groupBy(col("l_orderkey").alias("ro"), col("l_partkey").alias("rp")).agg(
        F.sum("l_quantity").alias("rq"))
    s = match(t.lineitem, back, "left", l_orderkey="ro", l_partkey="rp")
    return s.groupBy("l_linenumber").agg(F.sum("l_quantity").alias("sold"), F.sum(F.coalesce("rq", F.lit(0.0))).alias("returned"))


@query
def j4_anti_by_null(t: Tables):
    returned = t.lineitem.where("l_returnflag = 'R'").select(col("l_orderkey").alias("r"))
    return match(t.orders, returned, "left_anti", o_orderkey="r").select("o_orderkey", "o_custkey")


@query
def j5_full_outer(t: Tables):
    a = t.orders.where("o_orderstatus = 'F'").groupBy(col("o_custkey").alias("ka")).agg(F.count("*").alias("final"))
    b = t.orders.where("o_totalprice > 150000").groupBy(col("o_custkey").alias("kb")).agg(F.count("*").alias("large"))
    s = match(a, b, "full", ka="kb")
    return s.select(F.coalesce("ka", "kb").alias("custkey"), "final", "large")


@query
def j6_exists(t: Tables):
    big = t.lineitem.where("l_quantity >= 49").select(col("l_orderkey").alias("k"))
    return match(t.orders, big, "left_semi", o_orderkey="k").groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query
def j7_exists_other_value(t: Tables):
    """Lines of orders that also have a line from another supplier, without a self-join."""
    spread = t.lineitem.groupBy(col("l_orderkey").alias("k")).agg(
        F.min("l_suppkey").alias("lo"), F.max("l_suppkey").alias("hi")).where("lo < hi")
    return match(t.lineitem, spread, "left_semi", l_orderkey="k").groupBy("l_suppkey").agg(F.count("*").alias("n"))


@query
def j8_not_exists(t: Tables):
    late = t.lineitem.where("l_linestatus = 'F'").select(col("l_orderkey").alias("k"))
    return match(t.orders, late, "left_anti", o_orderkey="k").agg(F.count("*").alias("n"), total("o_totalprice").alias("worth"))


@query
def j9_exists_or_exists(t: Tables):
    dear = t.orders.where("o_totalprice > 400000").select(col("o_custkey").alias("k"))
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").select(col("o_custkey").alias("k"))
    return match(t.customer, dear.union(urgent), "left_semi", c_custkey="k").select("c_custkey")


@query
def j10_in_subquery(t: Tables):
    parts = t.part.where("p_brand = 'Brand#3'").select(col("p_partkey").alias("k"))
    return match(t.lineitem, parts, "left_semi", l_partkey="k").select("l_orderkey", "l_partkey", "l_linenumber")


@query
def j11_list_or_subquery(t: Tables):
    tall = t.part.where("p_size > 48").select(col("p_partkey").alias("k"))
    s = match(t.lineitem, tall, "left", l_partkey="k")
    return s.where(col("l_suppkey").isin(1, 2, 3) | col("k").isNotNull()).select("l_orderkey", "l_partkey", "l_suppkey")


@query
def j12_residual(t: Tables):
    s = match(t.lineitem, t.orders, l_orderkey="o_orderkey")
    return s.where("l_shipdate > date_add(to_date(o_orderdate), 5) and l_extendedprice < o_totalprice").groupBy(
        "o_orderstatus").agg(F.count("*").alias("n"))


def monthly(t: Tables):
    o = t.orders.select("o_totalprice", (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("m"))
    return o.groupBy("m").agg(total("o_totalprice").alias("v"))


@query
def j13_shifted_self_join(t: Tables):
    now, before = monthly(t), monthly(t).toDF("m0", "v0")
    return now.join(before, col("m") == col("m0") + 1).select(col("m").alias("month"), "v", "v0")


@query
def j14_one_row_aggregates(t: Tables):
    """Independent one-row aggregates, taken together in one pass."""
    early = F.hour("ts") < 12
    return t.events.agg(F.count_if(early).alias("am"), F.count_if(~early).alias("pm"),
                        F.count_if(col("event_type") == "purchase").alias("bought"))


@query
def j15_expression_keys(t: Tables):
    a = t.part.select(F.upper(F.split_part("p_name", F.lit(" "), F.lit(1))).alias("word")).groupBy("word").agg(
        F.count("*").alias("parts"))
    b = t.part.where("p_size > 25").select(F.upper(F.split_part("p_name", F.lit(" "), F.lit(1))).alias("word2")).groupBy(
        "word2").agg(F.count("*").alias("tall"))
    return match(a, b, word="word2").select("word", "parts", "tall")


@query
def j16_two_roles(t: Tables):
    buyer, seller = renamed(t.nation, "n_", "b_"), renamed(t.nation, "n_", "s_")
    s = match(match(t.lineitem, t.orders, l_orderkey="o_orderkey"), t.customer, o_custkey="c_custkey")
    s = match(s, t.supplier, l_suppkey="s_suppkey")
    s = match(s, buyer, c_nationkey="b_nationkey")
    s = s.join(seller.select(col("s_nationkey").alias("sn"), col("s_name").alias("seller")), col("s_nationkey") == col("sn"))
    return s.where("b_nationkey <> sn").groupBy(col("b_name").alias("buyer"), "seller").agg(F.count("*").alias("n"))


@query
def j17_enrich_left(t: Tables):
    who = t.customer.where("c_custkey % 3 <> 0").select(col("c_custkey").alias("k"), "c_mktsegment")
    return match(t.events, who, "left", user_id="k").select("event_id", "user_id", col("c_mktsegment").alias("segment"))


@query
def j18_enrich_many(t: Tables):
    """Errors of each customer and month as an array of structs; one row with nulls when there are none."""
    item = F.struct(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"), col("value").alias("value"))
    errors = nested(t.events.where("event_type = 'error'"), ["user_id"], item, "errors", F.date_format("ts", "yyyy-MM"))
    s = match(t.customer, errors, "left", c_custkey="user_id")
    return s.select("c_custkey", "part", F.to_json("errors").alias("errors"))


@query
def j20_result_with_stats(t: Tables):
    stats = t.lineitem.groupBy(col("l_orderkey").alias("k")).agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("units"))
    return match(t.orders, stats, o_orderkey="k").select("o_orderkey", "o_totalprice", "lines", "units")


@query
def j21_left_and_inner(t: Tables):
    views = t.events.where("event_type = 'view'").groupBy(col("user_id").alias("v")).agg(F.count("*").alias("views"))
    clicks = t.events.where("event_type = 'click'").groupBy(col("user_id").alias("c")).agg(F.count("*").alias("clicks"))
    s = match(match(views, clicks, "left", v="c"), t.customer, v="c_custkey")
    s = match(s, t.nation, c_nationkey="n_nationkey")
    return s.select(col("v").alias("user_id"), "n_name", "views", F.coalesce("clicks", F.lit(0)).alias("clicks"))


# ---- aggregation -----------------------------------------------------------

@query
def g1_grouped(t: Tables):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), total("l_extendedprice").alias("sum_price"),
        total(revenue()).alias("sum_revenue"), F.avg("l_quantity").alias("avg_qty"),
        F.min("l_shipdate").alias("first_ship"), F.max("l_discount").alias("max_disc"), F.count("*").alias("n"))


@query
def g2_global_on_empty(t: Tables):
    return t.orders.where("o_totalprice < 0").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("worth"))


@query
def g3_distinct_counts(t: Tables):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count_distinct("l_orderkey").alias("orders"), F.count_distinct("l_partkey", "l_suppkey").alias("pairs"),
        F.count_distinct("l_suppkey").alias("suppliers"))


@query
def g4_spread(t: Tables):
    return t.lineitem.groupBy("l_suppkey").agg(
        F.round(F.stddev_samp("l_quantity"), 6).alias("sd"),
        F.round(F.stddev_samp("l_quantity") / F.avg("l_quantity"), 6).alias("cov"))


@query
def g5_rollup(t: Tables):
    return t.part.rollup("p_type", "p_brand", "p_size").agg(
        F.count("*").alias("n"), total("p_retailprice").alias("worth"), F.grouping_id().cast("bigint").alias("level"))


@query
def g6_levels_by_null(t: Tables):
    """Rollup level read from null keys; a real null key looks like a subtotal."""
    p = t.part.withColumn("kind", F.when(col("p_partkey") % 41 != 0, col("p_type")))
    out = p.rollup("kind", "p_brand").agg(F.count("*").alias("n"), F.grouping_id("kind", "p_brand").alias("g"))
    return out.select("kind", "p_brand", "n", (col("kind").isNull().cast("int") + col("p_brand").isNull().cast("int")).alias("by_null"),
                      F.when(col("g") == 0, 0).when(col("g") == 1, 1).otherwise(2).alias("by_flag"))


@query
def g7_cube_with_all(t: Tables):
    """Each row counts under its own key and under ``all``; null keys join ``all`` as well."""
    e = t.events.select("event_type", F.when(col("user_id") % 7 != 0, (col("user_id") % 7).cast("string")).alias("grp"), "value")
    e = e.withColumn("event_type", F.explode(F.array(col("event_type"), F.lit("all"))))
    e = e.withColumn("grp", F.explode(F.array(col("grp"), F.lit("all"))))
    return e.groupBy("event_type", F.coalesce("grp", F.lit("all")).alias("grp")).agg(
        F.count("*").alias("n"), total("value").alias("value"))


@query
def g8_having(t: Tables):
    typical = t.orders.groupBy("o_custkey").agg(total("o_totalprice").alias("v")).agg(mean("v").alias("m"))
    s = t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), total("o_totalprice").alias("worth"))
    return s.where((col("n") >= 5) & (col("worth") > typical.scalar()))


@query
def g9_pivot(t: Tables):
    return t.events.withColumn("half", F.when(F.hour("ts") < 12, "am").otherwise("pm")).groupBy("event_type").pivot(
        "half", ["am", "pm"]).agg(F.count(F.lit(1)).alias("n"))


@query
def g10_conditional_count(t: Tables):
    return t.events.groupBy("user_id").agg(
        F.count(F.when(col("event_type") == "click", col("event_id"))).alias("clicks"), F.count("event_id").alias("n"))


@query
def g11_mean_of_means(t: Tables):
    per = t.lineitem.groupBy("l_suppkey", "l_orderkey").agg(F.count("*").alias("lines"), F.avg("l_quantity").alias("q"))
    return per.groupBy("l_suppkey").agg(F.avg("lines").alias("avg_lines"), F.round(F.avg("q"), 6).alias("avg_of_avg"))


@query
def g12_ratio_of_totals(t: Tables):
    return t.lineitem.groupBy("l_suppkey").agg((F.count("*") / F.count_distinct("l_orderkey")).alias("avg_lines"))


@query
def g13_mode(t: Tables):
    s = t.lineitem.groupBy("l_quantity").agg(F.count("*").alias("n"))
    return leading(s, "-n", "l_quantity", n=1)


@query
def g14_geomean(t: Tables):
    return t.orders.groupBy("o_orderpriority").agg(F.round(F.exp(F.avg(F.ln("o_totalprice"))), 4).alias("geomean"))


@query
def g15_percentiles(t: Tables):
    """Exact high percentiles without a sort in one task."""
    out = percentiles(t.lineitem, "l_extendedprice", [0.99, 0.999, 0.9999])
    return out.select("share", F.round("value", 4).alias("value"))


@query
def g15_sketched_percentiles(t: Tables):
    """The same percentiles from one stored sketch per file: whether their ranks are within the bound of the sketch, and the rows it has seen."""
    path, shares = scratch(t.spark, "sketches"), [0.5, 0.99, 0.999, 0.9999]
    sketches.store_sketches(t.lineitem, col("l_extendedprice"), path)
    stored = t.spark.read.parquet(path)
    gaps = sketches.rank_gap(t.lineitem, col("l_extendedprice"), sketches.sketched_percentiles(stored, shares))
    return gaps.select("share", (col("gap") <= sketches.rank_error()).alias("within"), stored.agg(F.sum("n")).scalar().alias("rows"))


@query
def g16_lower_median(t: Tables):
    return percentiles(t.lineitem, "l_extendedprice", [0.5], ["l_returnflag"], interpolate=False).select(
        "l_returnflag", col("value").alias("median"))


@query
def g17_word_count(t: Tables):
    words = t.documents.select(F.explode(text.words(col("text"), apostrophes=True)).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


@query
def g18_text_metrics(t: Tables):
    """Counters over every line: words, their lengths and blank lines."""
    lines = t.documents.select(F.explode(F.split(F.concat("text", F.lit("\n\n  ")), "\n")).alias("line"))
    lengths = F.transform(text.words(F.trim("line"), apostrophes=True), lambda w: F.length(w))
    n = lines.select(text.blank(col("line")).alias("blank"), lengths.alias("len"))
    n = n.select("blank", F.size("len").alias("words"), F.aggregate("len", F.lit(0), lambda a, x: a + x).alias("chars"),
                 F.array_min("len").alias("lo"), F.array_max("len").alias("hi"))
    out = n.agg(F.sum("words").alias("words"), F.sum("chars").alias("word_lengths"), F.min("lo").alias("min_len"),
                F.max("hi").alias("max_len"), F.count_if("blank").alias("empty_lines"))
    return out.withColumn("mean_len", col("word_lengths") / col("words"))


# ---- windows ---------------------------------------------------------------

@query
def w1_first_per_group(t: Tables):
    """Best-selling brand per year; ties go to the first name."""
    s = match(match(t.lineitem, t.orders, l_orderkey="o_orderkey"), t.part, l_partkey="p_partkey")
    s = s.groupBy(F.year("o_orderdate").alias("year"), "p_brand").agg(F.sum("l_quantity").alias("q"))
    rn = F.row_number().over(W.partitionBy("year").orderBy(col("q").desc(), "p_brand"))
    return s.withColumn("rn", rn).where("rn = 1").select("year", "p_brand", "q")


@query
def w2_rank_per_group(t: Tables):
    s = t.orders.groupBy("o_orderpriority", "o_custkey").agg(total("o_totalprice").alias("v"))
    rk = F.rank().over(W.partitionBy("o_orderpriority").orderBy(col("v").desc()))
    return s.withColumn("rk", rk).where("rk <= 5").withColumn("rk", col("rk").cast("bigint"))


@query
def w3_both_ends(t: Tables):
    """Customers by the worth of their orders, an amount in cents, so that ties are rare and small."""
    s = t.orders.groupBy("o_custkey").agg(total("o_totalprice").alias("worth"))
    up = first_ranks(s, "worth", "rk", 10).select("rk", col("o_custkey").alias("least"))
    down = first_ranks(s, "worth", "rk2", 10, descending=True).select("rk2", col("o_custkey").alias("most"))
    return match(up, down, rk="rk2").select("rk", "least", "most")


@query
def w4_either_rank(t: Tables):
    s = t.part.select("p_partkey", "p_size", "p_retailprice")
    s = with_rank(with_rank(s, "p_size", "by_size"), "p_retailprice", "by_price", descending=True)
    return s.where("by_size <= 10 or by_price <= 10")


@query
def w5_rank_in_parent(t: Tables):
    s = t.part.rollup("p_type", "p_brand").agg(total("p_retailprice").alias("v"), F.grouping_id().cast("int").alias("lvl"))
    rk = F.rank().over(W.partitionBy("lvl", F.when(col("lvl") == 0, col("p_type"))).orderBy(col("v").desc()))
    return s.withColumn("rk", rk.cast("bigint"))


@query
def w6_share(t: Tables):
    s = t.lineitem.groupBy("l_returnflag", "l_suppkey").agg(total("l_extendedprice").alias("v"))
    s = with_group(s, ["l_returnflag"], total("v").alias("all_v"))
    return s.select("l_returnflag", "l_suppkey", "v", (col("v") * 100 / col("all_v")).alias("share"))


@query
def w7_deviation(t: Tables):
    s = t.orders.groupBy("o_orderpriority", F.year("o_orderdate").alias("y")).agg(total("o_totalprice").alias("v"))
    s = with_group(s, ["o_orderpriority"], mean("v").alias("m"))
    return s.where(ratio(F.abs(col("v") - col("m")), "m") > 0.02)


@query
def w8_running(t: Tables):
    days = t.events.groupBy("event_type", F.to_date("ts").alias("day")).agg(total("value").alias("v"))
    so_far = W.partitionBy("event_type").orderBy("day").rowsBetween(W.unboundedPreceding, 0)
    return days.select("event_type", "day", "v", F.round(F.sum("v").over(so_far), 2).alias("running"),
                       F.max("v").over(so_far).alias("peak"))


@query
def w9_neighbours(t: Tables):
    s = t.orders.groupBy("o_orderpriority", (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("m")).agg(
        total("o_totalprice").alias("v"))
    by = W.partitionBy("o_orderpriority").orderBy("m")
    s = s.select("*", F.lag("v").over(by).alias("prev"), F.lead("v").over(by).alias("next"))
    return s.where("prev is not null and next is not null")


# ---- order, limit, sets ----------------------------------------------------

@query
def o1_sort(t: Tables):
    return t.nation.orderBy(col("n_regionkey").desc(), F.length("n_name"), "n_name")


@query
def o2_leading_rows(t: Tables):
    return leading(t.orders.select("o_orderkey", "o_totalprice"), "-o_totalprice")


@query
def o3_union_all(t: Tables):
    a = t.customer.select(F.lit("c").alias("kind"), col("c_nationkey").alias("nation"))
    b = t.supplier.select(F.lit("s").alias("kind"), col("s_nationkey").alias("nation"))
    return union_all(a, b).groupBy("kind", "nation").agg(F.count("*").alias("n"))


@query
def o4_union_distinct(t: Tables):
    return t.customer.select(col("c_nationkey").alias("k")).union(t.supplier.select("s_nationkey")).distinct()


@query
def o5_intersect(t: Tables):
    def buyers(status):
        return t.orders.where(col("o_orderstatus") == status).select("o_custkey")
    return buyers("F").intersect(buyers("O")).intersect(buyers("P"))


@query
def o6_except(t: Tables):
    def buyers(status):
        return t.orders.where(col("o_orderstatus") == status).select("o_custkey")
    return t.customer.select(col("c_custkey").alias("o_custkey")).subtract(buyers("F")).subtract(buyers("O"))


@query
def o7_shared_subplan(t: Tables):
    s = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(total("o_totalprice").alias("v"))
    a, b = s.where("y = 1997"), s.where("y = 1998").toDF("k", "y2", "v2")
    return match(a, b, o_custkey="k").where("v2 > v").select("o_custkey", "v", "v2")


@query
def o8_chained_steps(t: Tables):
    shown = t.events.where("event_type = 'view'").groupBy("user_id").agg(F.count("*").alias("shown"))
    bought = t.events.where("event_type = 'purchase'").groupBy(col("user_id").alias("u")).agg(total("value").alias("spent"))
    both = match(shown, bought, user_id="u").drop("u")
    return both.where("shown > 2").agg(F.count("*").alias("users"), total("spent").alias("spent"))


@query
def o9_flatten_failures(t: Tables):
    a = t.events.where("value < 1").select(F.lit("price").alias("step_name"), "user_id")
    b = t.events.where("event_type = 'error'").select(F.lit("event").alias("step_name"), "user_id")
    return union_all(a, b)


@query
def o10_key_split(t: Tables):
    """Repeatable 60/20/20 split by key; the same key always lands on the same side."""
    slot = F.pmod(col("o_orderkey") * 7919 + 11, F.lit(100))
    side = F.when(slot < 60, "train").when(slot < 80, "validate").otherwise("test")
    return t.orders.select("o_orderkey", side.alias("side"))


@query
def o10_random_split(t: Tables):
    """Seeded random 60/20/20 split: the parts share no row, miss none and have about their shares."""
    parts = t.orders.select("o_orderkey").randomSplit([0.6, 0.2, 0.2], seed=7)
    sides = union_all(*[p.select("o_orderkey", F.lit(i).alias("side"), F.lit(float(w)).alias("share")) for i, (p, w) in enumerate(zip(parts, (0.6, 0.2, 0.2)))])
    n = t.orders.agg(F.count("*")).scalar()
    return sides.groupBy("side", "share").agg(F.count("*").alias("own"), F.count_distinct("o_orderkey").alias("keys")).agg(
        F.sum("own").alias("n"), F.sum("keys").alias("keys"), F.max(F.abs(col("own") / n - col("share")) < 0.05).alias("near"),
        F.count("*").alias("parts"))


@query
def o11_alias_in_group(t: Tables):
    s = t.part.withColumn("word", F.substring("p_name", 1, 3))
    return s.groupBy("word").agg(F.count("*").alias("n")).orderBy("word")
