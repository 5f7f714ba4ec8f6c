"""Conditional sums: pivots, weekly comparisons and before/after windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.money import half_up, mean, total
from millrace.operators.relational import leading, match, renamed, sorted_rows, union_all
from millrace.plans.star.channels import all_sales
from millrace.plans.star.registry import report
from millrace.plans.star.simple import DAY_NAMES, by_weekday, days, stock_on
from millrace.plans.star.tables import Star
from millrace.session import materialized

col = F.col
_DAYS = [d[:3].lower() for d in DAY_NAMES]


def week_days(t: Star, period: str) -> DataFrame:
    """All days of the weeks that touch a period."""
    touched = days(t, period).select(col("d_week_seq").alias("touched_week"))
    return match(t.date_dim, touched, "left_semi", d_week_seq="touched_week")


def week_rows(weekly: DataFrame, calendar: DataFrame, suffix: str) -> DataFrame:
    """Weekly totals once per calendar day of the week that falls in the period."""
    weeks = calendar.select(col("d_week_seq").alias("week"))
    out = match(weekly, weeks, d_week_seq="week").drop("week")
    return out.toDF(*[c + suffix for c in out.columns])


@report
def q2(t: Star, year: int = 2001) -> DataFrame:
    s = match(all_sales(t, "web", "catalog"), week_days(t, f"d_year in ({year}, {year + 1})"), sold_date_sk="d_date_sk")
    weekly = materialized(s.groupBy("d_week_seq").agg(*by_weekday("ext_sales_price")))
    now = week_rows(weekly, days(t, f"d_year = {year}"), "1")
    later = week_rows(weekly, days(t, f"d_year = {year + 1}"), "2")
    both = now.join(later, col("d_week_seq1") == col("d_week_seq2") - 53)
    ratios = [half_up(col(f"{d}_sales1") / col(f"{d}_sales2"), 2).alias(f"{d}_ratio") for d in _DAYS]
    return sorted_rows(both.select("d_week_seq1", *ratios), "d_week_seq1")


@report
def q59(t: Star, month: int = 1185) -> DataFrame:
    s = match(t.store_sales, week_days(t, f"d_month_seq between {month} and {month + 23}"), ss_sold_date_sk="d_date_sk")
    weekly = materialized(s.groupBy("d_week_seq", "ss_store_sk").agg(*by_weekday("ss_sales_price")))
    weekly = match(weekly, t.store.select("s_store_sk", "s_store_name", "s_store_id"),
                   ss_store_sk="s_store_sk").drop("ss_store_sk", "s_store_sk")
    now = week_rows(weekly, days(t, f"d_month_seq between {month} and {month + 11}"), "1")
    later = week_rows(weekly, days(t, f"d_month_seq between {month + 12} and {month + 23}"), "2")
    both = now.join(later, (col("s_store_id1") == col("s_store_id2"))
                    & (col("d_week_seq1") == col("d_week_seq2") - 52))
    ratios = [(col(f"{d}_sales1") / col(f"{d}_sales2")).alias(f"{d}_ratio") for d in _DAYS]
    return leading(both.select("s_store_name1", "s_store_id1", "d_week_seq1", *ratios),
                   "s_store_name1", "s_store_id1", "d_week_seq1")


@report
def q9(t: Star, thresholds=(409437, 4595804, 1333710, 2361102, 1517817), width: int = 20) -> DataFrame:
    """Count, mean tax and mean paid of every band in one pass over the sales."""
    bands = [(i, col("ss_quantity").between(i * width + 1, (i + 1) * width)) for i in range(len(thresholds))]
    aggs = []
    for i, inside in bands:
        aggs += [F.count_if(inside).alias(f"n{i}"),
                 mean(F.when(inside, col("ss_ext_tax"))).alias(f"tax{i}"),
                 mean(F.when(inside, col("ss_net_paid"))).alias(f"paid{i}")]
    once = t.store_sales.agg(*aggs).where(t.reason.where("r_reason_sk = 1").exists())
    return once.select(*[F.when(col(f"n{i}") > limit, col(f"tax{i}")).otherwise(col(f"paid{i}"))
                         .alias(f"bucket{i + 1}") for i, limit in enumerate(thresholds)])


@report
def q28(t: Star, bands=((0, 5, 11, 460, 14), (6, 10, 91, 1430, 32), (11, 15, 66, 920, 4),
                        (16, 20, 142, 3054, 80), (21, 25, 135, 14180, 38), (26, 30, 28, 2513, 42)),
        widths=(10, 1000, 20)) -> DataFrame:
    """Each band: (quantity from, to, list price from, coupon from, wholesale cost from)."""
    list_w, coupon_w, cost_w = widths
    band = F.lit(None).cast("int")
    for i, (lo, hi, price, coupon, cost) in enumerate(bands, 1):
        kept = (col("ss_list_price").between(price, price + list_w)
                | col("ss_coupon_amt").between(coupon, coupon + coupon_w)
                | col("ss_wholesale_cost").between(cost, cost + cost_w))
        band = F.when(col("ss_quantity").between(lo, hi) & kept, i).otherwise(band)
    per_band = t.store_sales.withColumn("band", band).where("band is not null").groupBy("band").agg(
        mean("ss_list_price").alias("lp"), F.count("ss_list_price").alias("cnt"),
        F.count_distinct("ss_list_price").alias("cntd"))
    out = []
    for i in range(1, len(bands) + 1):
        mine = col("band") == i
        out += [F.max(F.when(mine, col("lp"))).alias(f"b{i}_lp"),
                F.coalesce(F.max(F.when(mine, col("cnt"))), F.lit(0)).alias(f"b{i}_cnt"),
                F.coalesce(F.max(F.when(mine, col("cntd"))), F.lit(0)).alias(f"b{i}_cntd")]
    return per_band.agg(*out)


def around(t: Star, pivot: str, length: int = 30) -> DataFrame:
    day = F.lit(pivot).cast("date")
    return t.date_dim.where(col("d_date").between(F.date_sub(day, length), F.date_add(day, length)))


@report
def q21(t: Star, pivot: str = "1998-04-08", price=(0.99, 1.49)) -> DataFrame:
    s = stock_on(t, around(t, pivot))
    s = match(s, t.item.where(col("i_current_price").between(*price)), inv_item_sk="i_item_sk")
    s = match(s, t.warehouse, inv_warehouse_sk="w_warehouse_sk")
    early = col("d_date") < F.lit(pivot).cast("date")
    qty = col("inv_quantity_on_hand")
    out = s.groupBy("w_warehouse_name", "i_item_id").agg(
        F.sum(F.when(early, qty).otherwise(0)).alias("inv_before"),
        F.sum(F.when(early, 0).otherwise(qty)).alias("inv_after"))
    change = F.when(col("inv_before") > 0, col("inv_after") / col("inv_before"))
    return leading(out.where(change.between(2.0 / 3.0, 3.0 / 2.0)), "w_warehouse_name", "i_item_id")


@report
def q40(t: Star, pivot: str = "1998-04-08", price=(0.99, 1.49)) -> DataFrame:
    s = match(t.catalog_sales, around(t, pivot), cs_sold_date_sk="d_date_sk")
    s = match(s, t.item.where(col("i_current_price").between(*price)), cs_item_sk="i_item_sk")
    s = match(s, t.warehouse, cs_warehouse_sk="w_warehouse_sk")
    s = match(s, t.catalog_returns, "left", cs_order_number="cr_order_number", cs_item_sk="cr_item_sk")
    early = col("d_date") < F.lit(pivot).cast("date")
    net = col("cs_sales_price") - F.coalesce("cr_refunded_cash", F.lit(0.0))
    out = s.groupBy("w_state", "i_item_id").agg(
        total(F.when(early, net).otherwise(0.0)).alias("sales_before"),
        total(F.when(early, 0.0).otherwise(net)).alias("sales_after"))
    return leading(out, "w_state", "i_item_id")


def ticket_buyers(t: Star, dates: str, homes, stores) -> DataFrame:
    s = match(t.store_sales, days(t, dates), ss_sold_date_sk="d_date_sk")
    s = match(s, t.household_demographics.where(homes), ss_hdemo_sk="hd_demo_sk")
    return match(s, t.store.where(stores), ss_store_sk="s_store_sk")


def ticket_sizes(t: Star, dates: str, ratio: float, counties, sizes) -> DataFrame:
    """Tickets with a number of lines in a range, with their customer."""
    vehicles = col("hd_vehicle_count")
    homes = (col("hd_buy_potential").isin(">10000", "5001-10000") & (vehicles > 0)
             & (F.when(vehicles > 0, col("hd_dep_count") / vehicles) > ratio))
    tickets = ticket_buyers(t, dates, homes, col("s_county").isin(list(counties))).groupBy(
        "ss_ticket_number", "ss_customer_sk").agg(F.count("*").alias("cnt"))
    return match(tickets.where(col("cnt").between(*sizes)), t.customer, ss_customer_sk="c_customer_sk").select(
        "c_last_name", "c_first_name", "c_salutation", "c_preferred_cust_flag", "ss_ticket_number", "cnt")


# counties of the two ticket-size reports (fixed values)
COUNTIES = ("Daviess County", "Franklin Parish", "Barrow County", "Luce County", "Fairfield County",
            "Richland County", "Ziebach County", "Walker County")


@report
def q34(t: Star, year: int = 1999, counties=COUNTIES, sizes=(15, 20)) -> DataFrame:
    out = ticket_sizes(t, f"(d_dom between 1 and 3 or d_dom between 25 and 28) and d_year between {year} and {year + 2}",
                       1.2, counties, sizes)
    return sorted_rows(out, "c_last_name", "c_first_name", "c_salutation", "-c_preferred_cust_flag")


@report
def q73(t: Star, year: int = 1999, counties=COUNTIES[:4], sizes=(1, 5)) -> DataFrame:
    out = ticket_sizes(t, f"d_dom between 1 and 2 and d_year between {year} and {year + 2}", 1, counties, sizes)
    return sorted_rows(out, "-cnt", "c_last_name")


def moved_buyers(t: Star, dates: str, homes: str, cities, *aggs) -> DataFrame:
    """Ticket totals where the purchase address is in another city than the current one."""
    s = ticket_buyers(t, dates, homes, col("s_city").isin(list(cities)))
    s = match(s, t.customer_address, ss_addr_sk="ca_address_sk").withColumnRenamed("ca_city", "bought_city")
    tickets = s.groupBy("ss_ticket_number", "ss_customer_sk", "ss_addr_sk", "bought_city").agg(*aggs)
    out = match(tickets, t.customer, ss_customer_sk="c_customer_sk")
    out = match(out, t.customer_address, c_current_addr_sk="ca_address_sk")
    return out.where(col("ca_city") != col("bought_city"))


@report
def q46(t: Star, dep: int = 6, vehicles: int = 3, year: int = 1999,
        cities=("Oakland", "Riverside", "Union", "Salem", "Greenwood")) -> DataFrame:
    out = moved_buyers(t, f"d_dow in (6, 0) and d_year between {year} and {year + 2}",
                       f"hd_dep_count = {dep} or hd_vehicle_count = {vehicles}", cities,
                       total("ss_coupon_amt").alias("amt"), total("ss_net_profit").alias("profit"))
    out = out.select("c_last_name", "c_first_name", "ca_city", "bought_city", "ss_ticket_number", "amt", "profit")
    return leading(out, "c_last_name", "c_first_name", "ca_city", "bought_city", "ss_ticket_number")


@report
def q68(t: Star, dep: int = 6, vehicles: int = 3, year: int = 1999, cities=("Oakland", "Riverside")) -> DataFrame:
    out = moved_buyers(t, f"d_dom between 1 and 2 and d_year between {year} and {year + 2}",
                       f"hd_dep_count = {dep} or hd_vehicle_count = {vehicles}", cities,
                       total("ss_ext_sales_price").alias("extended_price"),
                       total("ss_ext_list_price").alias("list_price"), total("ss_ext_tax").alias("extended_tax"))
    out = out.select("c_last_name", "c_first_name", "ca_city", "bought_city", "ss_ticket_number",
                     "extended_price", "extended_tax", "list_price")
    return leading(out, "c_last_name", "ss_ticket_number")


MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")


@report
def q66(t: Star, year: int = 2001, start: int = 49530, carriers=("DIAMOND", "AIRBORNE")) -> DataFrame:
    web = t.web_sales.select(
        *[col(f"ws_{c}").alias(c) for c in ("sold_date_sk", "sold_time_sk", "ship_mode_sk", "warehouse_sk")],
        (col("ws_sales_price") * col("ws_quantity")).alias("sales"),
        (col("ws_net_paid_inc_tax") * col("ws_quantity")).alias("net"))
    catalog = t.catalog_sales.select(
        *[col(f"cs_{c}").alias(c) for c in ("sold_date_sk", "sold_time_sk", "ship_mode_sk", "warehouse_sk")],
        (col("cs_ext_sales_price") * col("cs_quantity")).alias("sales"),
        (col("cs_net_paid_inc_ship_tax") * col("cs_quantity")).alias("net"))
    s = match(union_all(web, catalog), days(t, f"d_year = {year}"), sold_date_sk="d_date_sk")
    s = match(s, t.time_dim.where(col("t_time").between(start, start + 28800)), sold_time_sk="t_time_sk")
    s = match(s, t.ship_mode.where(col("sm_carrier").isin(list(carriers))), ship_mode_sk="sm_ship_mode_sk")
    s = match(s, t.warehouse, warehouse_sk="w_warehouse_sk")
    keys = ["w_warehouse_name", "w_warehouse_sq_ft", "w_city", "w_county", "w_state", "w_country"]
    sums = []
    for name in ("sales", "net"):
        sums += [total(F.when(col("d_moy") == i, col(name)).otherwise(0.0)).alias(f"{m}_{name}")
                 for i, m in enumerate(MONTHS, 1)]
    out = s.groupBy(*keys, F.lit(",".join(carriers)).alias("ship_carriers"), col("d_year").alias("year")).agg(*sums)
    per_foot = [(col(f"{m}_sales") / col("w_warehouse_sq_ft")).alias(f"{m}_sales_per_sq_foot") for m in MONTHS]
    out = out.select(*keys, "ship_carriers", "year", *[f"{m}_sales" for m in MONTHS], *per_foot,
                     *[f"{m}_net" for m in MONTHS])
    return leading(out, "w_warehouse_name")


def stock_variation(t: Star, year: int, month: int, least: float | None) -> DataFrame:
    """Item and warehouse pairs that vary strongly in one month and in the next."""
    s = stock_on(t, days(t, f"d_year = {year} and d_moy in ({month}, {month + 1})"))
    s = match(match(s, t.item.select("i_item_sk"), inv_item_sk="i_item_sk"),
              t.warehouse.select("w_warehouse_sk", "w_warehouse_name"), inv_warehouse_sk="w_warehouse_sk")
    stats = s.groupBy("w_warehouse_name", "w_warehouse_sk", "i_item_sk", "d_moy").agg(
        F.stddev_samp("inv_quantity_on_hand").alias("stdev"), F.avg("inv_quantity_on_hand").alias("mean"))
    cov = F.when(col("mean") != 0, col("stdev") / col("mean"))
    stats = materialized(stats.withColumn("cov", F.round(cov, 6)).where("cov > 1").select(
        "w_warehouse_sk", "i_item_sk", "d_moy", "mean", "cov"))
    now = stats.where(f"d_moy = {month}")
    if least is not None:
        now = now.where(col("cov") > least)
    later = stats.where(f"d_moy = {month + 1}").toDF(*[c + "2" for c in stats.columns])
    both = match(now, later, w_warehouse_sk="w_warehouse_sk2", i_item_sk="i_item_sk2")
    return sorted_rows(both, "w_warehouse_sk", "i_item_sk", "d_moy", "mean", "cov", "d_moy2", "mean2", "cov2")


@report
def q39(t: Star, year: int = 1998, month: int = 4) -> DataFrame:
    return stock_variation(t, year, month, None)


@report
def q39b(t: Star, year: int = 1998, month: int = 4) -> DataFrame:
    return stock_variation(t, year, month, 1.5)


@report
def q72(t: Star, potential: str = "1001-5000", marital: str = "M", year: int = 2001) -> DataFrame:
    """Stock of the item in the week of the order that could not cover it."""
    sold = renamed(t.date_dim, "d_", "d1_").where(f"d1_year = {year}")
    shipped = renamed(t.date_dim.select("d_date_sk", "d_date"), "d_", "d3_")
    s = match(t.catalog_sales, sold, cs_sold_date_sk="d1_date_sk")
    s = match(s, shipped, cs_ship_date_sk="d3_date_sk").where("d3_date > date_add(d1_date, 5)")
    s = match(s, t.customer_demographics.where(col("cd_marital_status") == marital), cs_bill_cdemo_sk="cd_demo_sk")
    s = match(s, t.household_demographics.where(col("hd_buy_potential") == potential), cs_bill_hdemo_sk="hd_demo_sk")
    weeks = sold.select(col("d1_week_seq").alias("sold_week")).distinct()
    stock = stock_on(t, match(t.date_dim.select("d_date_sk", "d_week_seq"), weeks, "left_semi", d_week_seq="sold_week"))
    s = match(s, stock, cs_item_sk="inv_item_sk", d1_week_seq="d_week_seq").drop("d_date_sk", "d_week_seq")
    s = s.where("inv_quantity_on_hand < cs_quantity")
    s = match(match(s, t.warehouse, inv_warehouse_sk="w_warehouse_sk"), t.item, cs_item_sk="i_item_sk")
    s = match(s, t.promotion.select("p_promo_sk"), "left", cs_promo_sk="p_promo_sk")
    s = match(s, t.catalog_returns.select("cr_item_sk", "cr_order_number"), "left",
              cs_item_sk="cr_item_sk", cs_order_number="cr_order_number")
    out = s.groupBy("i_item_desc", "w_warehouse_name", col("d1_week_seq").alias("d_week_seq")).agg(
        F.count_if(col("p_promo_sk").isNull()).alias("no_promo"),
        F.count_if(col("p_promo_sk").isNotNull()).alias("promo"), F.count("*").alias("total_cnt"))
    return leading(out, "-total_cnt", "i_item_desc", "w_warehouse_name", "d_week_seq")


@report
def q76(t: Star) -> DataFrame:
    """Sales whose address, page or warehouse key is missing."""
    parts = []
    for channel, p, key in (("store", "ss_", "addr_sk"), ("web", "ws_", "web_page_sk"),
                            ("catalog", "cs_", "warehouse_sk")):
        parts.append(t.table(f"{channel}_sales").where(col(p + key).isNull()).select(
            F.lit(channel).alias("channel"), F.lit(p + key).alias("col_name"),
            col(p + "sold_date_sk").alias("date_sk"), col(p + "item_sk").alias("item_sk"),
            col(p + "ext_sales_price").alias("price")))
    s = match(match(union_all(*parts), t.date_dim, date_sk="d_date_sk"), t.item, item_sk="i_item_sk")
    keys = ["channel", "col_name", "d_year", "d_qoy", "i_category"]
    return leading(s.groupBy(*keys).agg(F.count("*").alias("sales_cnt"), total("price").alias("sales_amt")), *keys)


@report
def q93(t: Star, reason: str = "Did not like the warranty") -> DataFrame:
    """The reason filter on the returned side makes the outer join an inner one."""
    why = t.reason.where(col("r_reason_desc") == reason)
    r = match(t.store_returns, why, "left_semi", sr_reason_sk="r_reason_sk")
    s = match(t.store_sales, r, ss_item_sk="sr_item_sk", ss_ticket_number="sr_ticket_number")
    kept = col("ss_quantity") - F.coalesce("sr_return_quantity", F.lit(0))
    out = s.groupBy("ss_customer_sk").agg(total(kept * col("ss_sales_price")).alias("sumsales"))
    return leading(out, "sumsales", "ss_customer_sk")
