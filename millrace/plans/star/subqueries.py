"""Reports that compare rows with an aggregate or test for related rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.functions.money import mean, total
from millrace.operators.relational import leading, match, union_all, with_group
from millrace.plans.star.channels import all_sales
from millrace.plans.star.registry import report
from millrace.plans.star.simple import any_of, day_span, days
from millrace.plans.star.tables import Star
from millrace.session import materialized

col = F.col


def above_group_mean(totals: DataFrame, keys: list[str], amount: str, factor: float) -> DataFrame:
    """Rows whose amount exceeds ``factor`` times the mean of their (non-null) group.

    The rows are kept, so that the facts behind them are read once for both
    the rows and their means.
    """
    known = materialized(totals.where(col(keys[0]).isNotNull()))
    return with_group(known, keys, mean(amount).alias("_mean")).where(
        col(amount) > col("_mean") * factor).drop("_mean")


@report
def q1(t: Star, year: int = 2000, state: str = "SD") -> DataFrame:
    r = match(t.store_returns, days(t, f"d_year = {year}"), sr_returned_date_sk="d_date_sk")
    totals = r.groupBy(col("sr_customer_sk").alias("ctr_customer_sk"), col("sr_store_sk").alias("ctr_store_sk")).agg(
        total("sr_fee").alias("ctr_total_return"))
    high = above_group_mean(totals, ["ctr_store_sk"], "ctr_total_return", 1.2)
    high = match(high, t.store.where(col("s_state") == state), "left_semi", ctr_store_sk="s_store_sk")
    return leading(match(high, t.customer, ctr_customer_sk="c_customer_sk").select("c_customer_id"), "c_customer_id")


def high_returners(t: Star, returned: DataFrame, customer: str, address: str, amount: str, state: str) -> DataFrame:
    """Customers living in ``state`` whose returns exceed 1.2 times the mean of the returning state."""
    r = match(returned, t.customer_address, **{address: "ca_address_sk"})
    totals = r.groupBy(col(customer).alias("ctr_customer_sk"), col("ca_state").alias("ctr_state")).agg(
        total(amount).alias("ctr_total_return"))
    high = above_group_mean(totals, ["ctr_state"], "ctr_total_return", 1.2)
    out = match(high, t.customer, ctr_customer_sk="c_customer_sk")
    return match(out, t.customer_address.where(col("ca_state") == state), c_current_addr_sk="ca_address_sk")


@report
def q30(t: Star, year: int = 2002, state: str = "IL") -> DataFrame:
    r = match(t.web_returns, days(t, f"d_year = {year}"), wr_returned_date_sk="d_date_sk")
    out = high_returners(t, r, "wr_returning_customer_sk", "wr_returning_addr_sk", "wr_return_amt", state)
    cols = ["c_customer_id", "c_salutation", "c_first_name", "c_last_name", "c_preferred_cust_flag", "c_birth_day",
            "c_birth_month", "c_birth_year", "c_birth_country", "c_login", "c_email_address",
            "c_last_review_date_sk", "ctr_total_return"]
    return leading(out.select(*cols), *cols)


@report
def q81(t: Star, year: int = 1998, state: str = "IL") -> DataFrame:
    r = match(t.catalog_returns, days(t, f"d_year = {year}"), cr_returned_date_sk="d_date_sk")
    out = high_returners(t, r, "cr_returning_customer_sk", "cr_returning_addr_sk", "cr_return_amt_inc_tax", state)
    cols = ["c_customer_id", "c_salutation", "c_first_name", "c_last_name", "ca_street_number", "ca_street_name",
            "ca_street_type", "ca_suite_number", "ca_city", "ca_county", "ca_state", "ca_zip", "ca_country",
            "ca_gmt_offset", "ca_location_type", "ctr_total_return"]
    return leading(out.select(*cols), *cols)


@report
def q6(t: Star, year: int = 2000, month: int = 2, factor: float = 1.2, least: int = 10) -> DataFrame:
    seq = t.date_dim.where(f"d_year = {year} and d_moy = {month}").select("d_month_seq").distinct()
    dear = above_group_mean(t.item.select("i_item_sk", "i_category", "i_current_price"), ["i_category"], "i_current_price", factor)
    s = match(t.store_sales, t.date_dim.where(col("d_month_seq") == seq.scalar()), ss_sold_date_sk="d_date_sk")
    s = match(s, dear, "left_semi", ss_item_sk="i_item_sk")
    s = match(s, t.customer, ss_customer_sk="c_customer_sk")
    s = match(s, t.customer_address, c_current_addr_sk="ca_address_sk")
    out = s.groupBy(col("ca_state").alias("state")).agg(F.count("*").alias("cnt")).where(col("cnt") >= least)
    return leading(out, "cnt")


def excess_discount(t: Star, fact: DataFrame, p: str, maker: int, start: str) -> DataFrame:
    items = t.item.where(col("i_manufact_id") == maker).select("i_item_sk")
    s = match(fact, day_span(t, start, 90), **{p + "sold_date_sk": "d_date_sk"})
    s = match(s, items, **{p + "item_sk": "i_item_sk"}).select("i_item_sk", p + "ext_discount_amt")
    high = above_group_mean(s, ["i_item_sk"], p + "ext_discount_amt", 1.3)
    return high.agg(total(p + "ext_discount_amt").alias("excess_discount_amount"))


@report
def q32(t: Star, maker: int = 269, start: str = "1998-03-18") -> DataFrame:
    return excess_discount(t, t.catalog_sales, "cs_", maker, start)


@report
def q92(t: Star, maker: int = 269, start: str = "1998-03-18") -> DataFrame:
    return excess_discount(t, t.web_sales, "ws_", maker, start)


def active(t: Star, fact: str, customer: str, sold: str, dates: str) -> DataFrame:
    """Customers with a sale in the period."""
    s = match(t.table(fact), days(t, dates), **{sold: "d_date_sk"})
    return s.where(col(customer).isNotNull()).select(col(customer).alias("buyer"))


def activity(t: Star, dates: str) -> tuple[DataFrame, DataFrame]:
    """(store buyers, web or catalog buyers) of the period."""
    store = active(t, "store_sales", "ss_customer_sk", "ss_sold_date_sk", dates)
    web = active(t, "web_sales", "ws_bill_customer_sk", "ws_sold_date_sk", dates)
    catalog = active(t, "catalog_sales", "cs_ship_customer_sk", "cs_sold_date_sk", dates)
    return store, union_all(web, catalog)


def people(t: Star, area) -> DataFrame:
    p = match(t.customer, t.customer_address.where(area), c_current_addr_sk="ca_address_sk")
    return match(p, t.customer_demographics, c_current_cdemo_sk="cd_demo_sk")


@report
def q10(t: Star, counties=("Walker County", "Richland County", "Gaines County", "Douglas County",
                           "Dona Ana County"), year: int = 2002, month: int = 4) -> DataFrame:
    store, other = activity(t, f"d_year = {year} and d_moy between {month} and {month + 3}")
    p = people(t, col("ca_county").isin(list(counties)))
    p = match(match(p, store, "left_semi", c_customer_sk="buyer"), other, "left_semi", c_customer_sk="buyer")
    keys = ["cd_gender", "cd_marital_status", "cd_education_status", "cd_purchase_estimate", "cd_credit_rating",
            "cd_dep_count", "cd_dep_employed_count", "cd_dep_college_count"]
    out = p.groupBy(*keys).agg(*[F.count("*").alias(f"cnt{i}") for i in range(1, 7)])
    return leading(out, *keys)


@report
def q35(t: Star, year: int = 1999) -> DataFrame:
    store, other = activity(t, f"d_year = {year} and d_qoy < 4")
    p = people(t, F.lit(True))
    p = match(match(p, store, "left_semi", c_customer_sk="buyer"), other, "left_semi", c_customer_sk="buyer")
    keys = ["ca_state", "cd_gender", "cd_marital_status", "cd_dep_count", "cd_dep_employed_count",
            "cd_dep_college_count"]
    aggs = []
    for i, c in enumerate(keys[3:], 1):
        aggs += [F.count("*").alias(f"cnt{i}"), F.avg(c).alias(f"avg{i}"), F.max(c).alias(f"max{i}"),
                 F.sum(c).alias(f"sum{i}")]
    return leading(p.groupBy(*keys).agg(*aggs), *keys)


@report
def q69(t: Star, states=("CO", "IL", "MN"), year: int = 1999, month: int = 1) -> DataFrame:
    store, other = activity(t, f"d_year = {year} and d_moy between {month} and {month + 2}")
    p = people(t, col("ca_state").isin(list(states)))
    p = match(match(p, store, "left_semi", c_customer_sk="buyer"), other, "left_anti", c_customer_sk="buyer")
    keys = ["cd_gender", "cd_marital_status", "cd_education_status", "cd_purchase_estimate", "cd_credit_rating"]
    out = p.groupBy(*keys).agg(*[F.count("*").alias(f"cnt{i}") for i in range(1, 4)])
    return leading(out, *keys)


def split_orders(fact: DataFrame, order: str, warehouse: str, asked: DataFrame) -> DataFrame:
    """Orders of the asked lines that were shipped from at least two warehouses, one row each."""
    fact = match(fact, asked.select(col(order).alias("asked_order")), "left_semi", **{order: "asked_order"})
    spread = fact.groupBy(col(order).alias("split_order")).agg(
        F.min(warehouse).alias("w_lo"), F.max(warehouse).alias("w_hi"))
    return spread.where("w_lo < w_hi").select("split_order")


def order_summary(s: DataFrame, order: str, ship_cost: str, profit: str) -> DataFrame:
    return s.agg(F.count_distinct(order).alias("order_count"), total(ship_cost).alias("total_shipping_cost"),
                 total(profit).alias("total_net_profit"))


@report
def q16(t: Star, start: str = "1999-4-01", state: str = "GA",
        counties=("Daviess County", "Franklin Parish", "Barrow County", "Luce County", "Fairfield County")) -> DataFrame:
    s = match(t.catalog_sales, day_span(t, start, 60), cs_ship_date_sk="d_date_sk")
    s = match(s, t.customer_address.where(col("ca_state") == state), cs_ship_addr_sk="ca_address_sk")
    s = match(s, t.call_center.where(col("cc_county").isin(list(counties))), cs_call_center_sk="cc_call_center_sk")
    # a line differs from another of its order only if it names a warehouse itself
    s = s.where(col("cs_warehouse_sk").isNotNull())
    s = match(s, split_orders(t.catalog_sales, "cs_order_number", "cs_warehouse_sk", s), "left_semi",
              cs_order_number="split_order")
    s = match(s, t.catalog_returns, "left_anti", cs_order_number="cr_order_number")
    return order_summary(s, "cs_order_number", "cs_ext_ship_cost", "cs_net_profit")


def company_web_orders(t: Star, start: str, state: str, company: str) -> DataFrame:
    s = match(t.web_sales, day_span(t, start, 60), ws_ship_date_sk="d_date_sk")
    s = match(s, t.customer_address.where(col("ca_state") == state), ws_ship_addr_sk="ca_address_sk")
    return match(s, t.web_site.where(col("web_company_name") == company), ws_web_site_sk="web_site_sk")


@report
def q94(t: Star, start: str = "1999-5-01", state: str = "TX", company: str = "pri") -> DataFrame:
    s = company_web_orders(t, start, state, company).where(col("ws_warehouse_sk").isNotNull())
    s = match(s, split_orders(t.web_sales, "ws_order_number", "ws_warehouse_sk", s), "left_semi",
              ws_order_number="split_order")
    s = match(s, t.web_returns, "left_anti", ws_order_number="wr_order_number")
    return order_summary(s, "ws_order_number", "ws_ext_ship_cost", "ws_net_profit")


@report
def q95(t: Star, start: str = "1999-5-01", state: str = "TX", company: str = "pri") -> DataFrame:
    s = company_web_orders(t, start, state, company)
    s = match(s, split_orders(t.web_sales, "ws_order_number", "ws_warehouse_sk", s), "left_semi", ws_order_number="split_order")
    s = match(s, t.web_returns, "left_semi", ws_order_number="wr_order_number")
    return order_summary(s, "ws_order_number", "ws_ext_ship_cost", "ws_net_profit")


# (category, colours, units, sizes) of the variants looked for (fixed values)
VARIANTS = (
    ("Women", ("orchid", "papaya"), ("Pound", "Lb"), ("petite", "medium")),
    ("Women", ("burlywood", "navy"), ("Bundle", "Each"), ("N/A", "extra large")),
    ("Men", ("bisque", "azure"), ("N/A", "Tsp"), ("small", "large")),
    ("Men", ("chocolate", "cornflower"), ("Bunch", "Gross"), ("petite", "medium")),
    ("Women", ("salmon", "midnight"), ("Oz", "Box"), ("petite", "medium")),
    ("Women", ("snow", "steel"), ("Carton", "Tbl"), ("N/A", "extra large")),
    ("Men", ("purple", "gainsboro"), ("Dram", "Unknown"), ("small", "large")),
    ("Men", ("metallic", "forest"), ("Gram", "Ounce"), ("petite", "medium")),
)


@report
def q41(t: Star, maker: int = 742, variants=VARIANTS) -> DataFrame:
    wanted = any_of([(col("i_category") == c) & col("i_color").isin(list(k)) & col("i_units").isin(list(u))
                     & col("i_size").isin(list(z)) for c, k, u, z in variants])
    makers = t.item.where(wanted).select(col("i_manufact").alias("maker_name"))
    items = match(t.item.where(col("i_manufact_id").between(maker, maker + 40)), makers, "left_semi",
                  i_manufact="maker_name")
    return leading(items.select("i_product_name").distinct(), "i_product_name")


@report
def q58(t: Star, day: str = "1998-02-19") -> DataFrame:
    """Items earning about the same in all three channels in one week."""
    week = t.date_dim.where(col("d_date") == F.lit(day).cast("date")).select("d_week_seq")
    s = match(all_sales(t), t.date_dim.where(col("d_week_seq") == week.scalar()), sold_date_sk="d_date_sk")
    s = match(s, t.item, item_sk="i_item_sk")
    names = {"store": "ss_item_rev", "catalog": "cs_item_rev", "web": "ws_item_rev"}
    rev = s.groupBy(col("i_item_id").alias("item_id")).agg(
        *[total(F.when(col("channel") == c, col("ext_sales_price"))).alias(n) for c, n in names.items()])
    close = F.lit(True)
    for a in names.values():
        for b in names.values():
            if a != b:
                close = close & col(a).between(F.lit(0.9) * col(b), F.lit(1.1) * col(b))
    average = (col("ss_item_rev") + col("cs_item_rev") + col("ws_item_rev")) / 3
    out = rev.where(close).withColumn("average", average)
    cols = ["item_id"]
    for n in names.values():
        cols += [n, (col(n) / col("average") * 100).alias(n[:3] + "dev")]
    return leading(out.select(*cols, "average"), "item_id", "ss_item_rev")


@report
def q83(t: Star, dates=("1998-01-02", "1998-10-15", "1998-11-10")) -> DataFrame:
    """Share of each channel in the returned quantity for the weeks of some dates."""
    listed = t.date_dim.where(col("d_date").isin([F.lit(d).cast("date") for d in dates])).select(
        col("d_week_seq").alias("listed_week")).distinct()
    calendar = match(t.date_dim, listed, "left_semi", d_week_seq="listed_week")
    facts = (("store_returns", "sr_"), ("catalog_returns", "cr_"), ("web_returns", "wr_"))
    r = union_all(*[t.table(f).select(F.lit(p).alias("src"), col(p + "returned_date_sk").alias("date_sk"),
                                      col(p + "item_sk").alias("item_sk"), col(p + "return_quantity").alias("qty"))
                    for f, p in facts])
    r = match(match(r, calendar, date_sk="d_date_sk"), t.item, item_sk="i_item_sk")
    sums = r.groupBy(col("i_item_id").alias("item_id")).agg(
        *[F.sum(F.when(col("src") == p, col("qty"))).alias(p + "item_qty") for _, p in facts],
        *[F.max(col("src") == p).alias(p + "seen") for _, p in facts])
    sums = sums.where("sr_seen and cr_seen and wr_seen")
    everything = col("sr_item_qty") + col("cr_item_qty") + col("wr_item_qty")
    cols = ["item_id"]
    for _, p in facts:
        cols += [p + "item_qty", (col(p + "item_qty") / everything / 3.0 * 100).alias(p + "dev")]
    return leading(sums.select(*cols, (everything / 3.0).alias("average")), "item_id", "sr_item_qty")


@report
def q65(t: Star, month: int = 1212) -> DataFrame:
    s = match(t.store_sales, days(t, f"d_month_seq between {month} and {month + 11}"), ss_sold_date_sk="d_date_sk")
    rev = materialized(s.where("ss_store_sk is not null").groupBy("ss_store_sk", "ss_item_sk").agg(
        total("ss_sales_price").alias("revenue")))
    low = with_group(rev, ["ss_store_sk"], mean("revenue").alias("ave")).where(col("revenue") <= col("ave") * 0.1)
    out = match(match(low, t.store, ss_store_sk="s_store_sk"), t.item, ss_item_sk="i_item_sk").select(
        "s_store_name", "i_item_desc", "revenue", "i_current_price", "i_wholesale_cost", "i_brand")
    return leading(out, "s_store_name", "i_item_desc")
