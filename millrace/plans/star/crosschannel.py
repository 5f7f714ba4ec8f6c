"""Reports that set the channels against each other or chain several facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.money import half_up, mean, ratio, total
from millrace.operators.relational import leading, match, renamed, sorted_rows, union_all
from millrace.plans.star.channels import CHANNELS, all_returns, all_sales, sales
from millrace.plans.star.registry import report
from millrace.plans.star.simple import days
from millrace.plans.star.tables import Star
from millrace.session import materialized

col = F.col


def growth(t: Star, channels: list[str], year: int, amount: Column, value, pairs) -> DataFrame:
    """Customers whose yearly growth in the first channel of every pair beats the second.

    One grouping by customer with a column per channel and year replaces the
    self-join of one row set per channel and year.
    """
    s = match(all_sales(t, *channels), days(t, f"d_year in ({year}, {year + 1})"), sold_date_sk="d_date_sk")
    s = s.where("customer_sk is not null").withColumn("amount", amount)
    totals = s.groupBy("customer_sk").agg(
        *[value(F.when((col("channel") == c) & (col("d_year") == year + i), col("amount"))).alias(f"{c}_{i}")
          for c in channels for i in (0, 1)])
    for c in channels:
        totals = totals.where(col(f"{c}_0") > 0)
    for a, b in pairs:
        totals = totals.where(ratio(f"{a}_1", f"{a}_0") > ratio(f"{b}_1", f"{b}_0"))
    return match(totals, t.customer, customer_sk="c_customer_sk")


def named(customers: DataFrame, *more: str) -> DataFrame:
    return customers.select(col("c_customer_id").alias("customer_id"), col("c_first_name").alias("customer_first_name"),
                            col("c_last_name").alias("customer_last_name"), *more)


@report
def q4(t: Star, year: int = 2001) -> DataFrame:
    margin = (col("ext_list_price") - col("ext_wholesale_cost") - col("ext_discount_amt") + col("ext_sales_price")) / 2
    out = growth(t, list(CHANNELS), year, margin, lambda c: total(c, 3), [("catalog", "store"), ("catalog", "web")])
    return leading(named(out, col("c_email_address").alias("customer_email_address")), "customer_id")


@report
def q11(t: Star, year: int = 2001) -> DataFrame:
    out = growth(t, ["store", "web"], year, col("ext_list_price") - col("ext_discount_amt"), total, [("web", "store")])
    return leading(named(out, col("c_email_address").alias("customer_email_address")), "customer_id")


@report
def q74(t: Star, year: int = 2001) -> DataFrame:
    out = growth(t, ["store", "web"], year, col("net_paid"), F.max, [("web", "store")])
    return leading(named(out), "customer_first_name", "customer_id", "customer_last_name")


@report
def q31(t: Star, year: int = 2000) -> DataFrame:
    s = match(all_sales(t, "store", "web"), days(t, f"d_year = {year} and d_qoy <= 3"), sold_date_sk="d_date_sk")
    s = match(s, t.customer_address.where("ca_county is not null"), addr_sk="ca_address_sk")
    cells = [total(F.when((col("channel") == c) & (col("d_qoy") == q), col("ext_sales_price"))).alias(f"{c}{q}")
             for c in ("store", "web") for q in (1, 2, 3)]
    by_county = s.groupBy("ca_county", "d_year").agg(*cells)
    out = by_county.where((ratio("web2", "web1") > ratio("store2", "store1"))
                          & (ratio("web3", "web2") > ratio("store3", "store2")))
    out = out.select("ca_county", "d_year", (col("web2") / col("web1")).alias("web_q1_q2_increase"),
                     (col("store2") / col("store1")).alias("store_q1_q2_increase"),
                     (col("web3") / col("web2")).alias("web_q2_q3_increase"),
                     (col("store3") / col("store2")).alias("store_q2_q3_increase"))
    return sorted_rows(out, "d_year")


def revenue_over_channels(t: Star, key: str, listed: DataFrame, year: int, month: int, offset: float) -> DataFrame:
    """Revenue by item key over all channels for buyers in one time zone."""
    s = match(all_sales(t), days(t, f"d_year = {year} and d_moy = {month}"), sold_date_sk="d_date_sk")
    s = match(s, match(t.item, listed.select(col(key).alias("listed")), "left_semi", **{key: "listed"}),
              item_sk="i_item_sk")
    s = match(s, t.customer_address.where(col("ca_gmt_offset") == offset), addr_sk="ca_address_sk")
    return s.groupBy(key).agg(total("ext_sales_price").alias("total_sales"))


@report
def q33(t: Star, category="Books", year=1999, month=3, offset=-6) -> DataFrame:
    listed = t.item.where(col("i_category") == category)
    return leading(revenue_over_channels(t, "i_manufact_id", listed, year, month, offset), "total_sales")


@report
def q56(t: Star, colours=("orchid", "chiffon", "lace"), year=2000, month=1, offset=-8) -> DataFrame:
    listed = t.item.where(col("i_color").isin(list(colours)))
    return leading(revenue_over_channels(t, "i_item_id", listed, year, month, offset), "total_sales")


@report
def q60(t: Star, category="Children", year=1999, month=9, offset=-6) -> DataFrame:
    listed = t.item.where(col("i_category") == category)
    return leading(revenue_over_channels(t, "i_item_id", listed, year, month, offset), "i_item_id", "total_sales")


@report
def q71(t: Star, manager: int = 1, year: int = 2000, month: int = 12) -> DataFrame:
    s = match(all_sales(t), days(t, f"d_year = {year} and d_moy = {month}"), sold_date_sk="d_date_sk")
    s = match(s, t.item.where(col("i_manager_id") == manager), item_sk="i_item_sk")
    s = match(s, t.time_dim.where("t_meal_time in ('breakfast', 'dinner')"), sold_time_sk="t_time_sk")
    out = s.groupBy(col("i_brand_id").alias("brand_id"), col("i_brand").alias("brand"), "t_hour", "t_minute").agg(
        total("ext_sales_price").alias("ext_price"))
    return sorted_rows(out, "-ext_price", "brand_id")


def name_days(t: Star, month: int, day: str) -> DataFrame:
    """Which channels saw a customer name on a day: one row per name and day."""
    s = match(all_sales(t), days(t, f"d_month_seq between {month} and {month + 11}"), sold_date_sk="d_date_sk")
    s = match(s, t.customer, customer_sk="c_customer_sk")
    return s.groupBy("c_last_name", "c_first_name", day).agg(*[F.max(col("channel") == c).alias(c) for c in CHANNELS])


@report
def q38(t: Star, month: int = 1212, day: str = "d_date") -> DataFrame:
    return name_days(t, month, day).agg(F.count_if(col("store") & col("catalog") & col("web")).alias("cnt"))


@report
def q87(t: Star, month: int = 1212, day: str = "d_date") -> DataFrame:
    return name_days(t, month, day).agg(F.count_if(col("store") & ~col("catalog") & ~col("web")).alias("cnt"))


@report
def q97(t: Star, month: int = 1212) -> DataFrame:
    def pairs(channel: str, p: str) -> DataFrame:
        s = match(sales(t, channel), days(t, f"d_month_seq between {month} and {month + 11}"), sold_date_sk="d_date_sk")
        return s.select(col("customer_sk").alias(p + "customer"), col("item_sk").alias(p + "item")).distinct()

    both = match(pairs("store", "s_"), pairs("catalog", "c_"), "full", s_customer="c_customer", s_item="c_item")
    s, c = col("s_customer").isNotNull(), col("c_customer").isNotNull()
    return both.agg(F.count_if(s & ~c).alias("store_only"), F.count_if(~s & c).alias("catalog_only"),
                    F.count_if(s & c).alias("store_and_catalog"))


@report
def q75(t: Star, category: str = "Sports", year: int = 2002) -> DataFrame:
    s = match(all_sales(t), t.item.where(col("i_category") == category), item_sk="i_item_sk")
    s = match(s, days(t, f"d_year in ({year - 1}, {year})"), sold_date_sk="d_date_sk")
    s = match(s, all_returns(t), "left", channel="r_channel", order_no="r_order_no", item_sk="r_item_sk")
    keys = ["i_brand_id", "i_class_id", "i_category_id", "i_manufact_id"]
    lines = s.select("d_year", *keys, (col("quantity") - F.coalesce("return_quantity", F.lit(0))).alias("cnt"),
                     (col("ext_sales_price") - F.coalesce("return_amt", F.lit(0.0))).alias("amt")).distinct()
    past, now = col("d_year") == year - 1, col("d_year") == year
    out = lines.groupBy(*keys).agg(
        F.sum(F.when(past, col("cnt"))).alias("prev_yr_cnt"), F.sum(F.when(now, col("cnt"))).alias("curr_yr_cnt"),
        total(F.when(past, col("amt"))).alias("prev_amt"), total(F.when(now, col("amt"))).alias("curr_amt"))
    known = " and ".join(f"{k} is not null" for k in keys)
    out = out.where(known).where("prev_yr_cnt is not null and curr_yr_cnt is not null").where(
        F.when(col("prev_yr_cnt") != 0, col("curr_yr_cnt") / col("prev_yr_cnt")) < 0.9)
    out = out.select(F.lit(year - 1).cast("bigint").alias("prev_year"), F.lit(year).cast("bigint").alias("year"), *keys,
                     "prev_yr_cnt", "curr_yr_cnt", (col("curr_yr_cnt") - col("prev_yr_cnt")).alias("sales_cnt_diff"),
                     F.round(col("curr_amt") - col("prev_amt"), 2).alias("sales_amt_diff"))
    return leading(out, "sales_cnt_diff")


@report
def q78(t: Star, year: int = 2000, by_item: bool = False, n: int = 100) -> DataFrame:
    """Kept store purchases next to what the customer kept from other channels.

    Catalog purchases match on year and customer; ``by_item`` also asks for
    the same item.
    """
    sold = match(all_sales(t), days(t, f"d_year = {year}"), sold_date_sk="d_date_sk")
    kept = match(sold, all_returns(t), "left_anti", channel="r_channel", order_no="r_order_no", item_sk="r_item_sk")
    sums = materialized(kept.groupBy("channel", "d_year", "item_sk", "customer_sk").agg(
        F.sum("quantity").alias("qty"), total("wholesale_cost").alias("wc"), total("sales_price").alias("sp")))

    def part(channel: str, p: str) -> DataFrame:
        return sums.where(col("channel") == channel).drop("channel").toDF(
            *[p + c for c in ("year", "item", "customer", "qty", "wc", "sp")])

    both = match(part("store", "s_"), part("web", "w_").where("w_qty > 0"), s_year="w_year", s_item="w_item",
                 s_customer="w_customer")
    on = {"s_year": "c_year", "s_customer": "c_customer", **({"s_item": "c_item"} if by_item else {})}
    catalog = part("catalog", "c_").where("c_qty > 0 and c_item is not null")
    # every kept row yields at least one result row and the report starts with
    # the row's own key, so its first rows come from the first rows here
    both = leading(match(both, catalog, "left_semi", **on), "s_year", "s_item", "s_customer", n=n)
    both = match(both, catalog, **on)
    out = both.select(
        col("s_year").alias("ss_sold_year"), col("s_item").alias("ss_item_sk"), col("s_customer").alias("ss_customer_sk"),
        half_up(col("s_qty") / F.coalesce(col("w_qty") + col("c_qty"), F.lit(1)), 2).alias("ratio"),
        col("s_qty").alias("store_qty"), col("s_wc").alias("store_wholesale_cost"), col("s_sp").alias("store_sales_price"),
        (col("w_qty") + col("c_qty")).alias("other_chan_qty"),
        F.round(col("w_wc") + col("c_wc"), 2).alias("other_chan_wholesale_cost"),
        F.round(col("w_sp") + col("c_sp"), 2).alias("other_chan_sales_price"))
    return leading(out, "ss_sold_year", "ss_item_sk", "ss_customer_sk", "-store_qty", "-store_wholesale_cost",
                   "-store_sales_price", "other_chan_qty", "other_chan_wholesale_cost", "other_chan_sales_price", "ratio", n=n)


@report
def q8(t: Star, zips: tuple = (), least: int = 10, quarter: int = 1, year: int = 2002) -> DataFrame:
    """Store profit near listed zips that also hold many preferred customers.

    A store counts once per matching zip, so the zips are counted per prefix.
    """
    homes = t.customer_address.select(F.substring("ca_zip", 1, 5).alias("zip"), "ca_address_sk")
    listed = homes.where(col("zip").isin(list(zips))).select("zip")
    loyal = match(homes, t.customer.where("c_preferred_cust_flag = 'Y'"), ca_address_sk="c_current_addr_sk")
    loyal = loyal.groupBy("zip").agg(F.count("*").alias("n")).where(col("n") > least).select("zip")
    prefixes = listed.intersect(loyal).groupBy(F.substring("zip", 1, 2).alias("prefix")).agg(F.count("*").alias("zips"))
    s = match(t.store_sales, days(t, f"d_qoy = {quarter} and d_year = {year}"), ss_sold_date_sk="d_date_sk")
    s = match(s, t.store.withColumn("s_prefix", F.substring("s_zip", 1, 2)), ss_store_sk="s_store_sk")
    s = match(s, prefixes, s_prefix="prefix")
    out = s.groupBy("s_store_name").agg(total(col("ss_net_profit") * col("zips")).alias("net_profit"))
    return leading(out, "s_store_name")


def frequent_items(t: Star, year: int, least: int) -> DataFrame:
    """Items sold more than ``least`` times on some day of four years."""
    s = match(t.store_sales, days(t, f"d_year between {year} and {year + 3}"), ss_sold_date_sk="d_date_sk")
    s = match(s, t.item, ss_item_sk="i_item_sk")
    often = s.groupBy(F.substring("i_item_desc", 1, 30).alias("itemdesc"), "i_item_sk", "d_date").agg(
        F.count("*").alias("cnt"))
    return often.where(col("cnt") > least).select(col("i_item_sk").alias("often_sk"))


def best_customers(t: Star, year: int, share: float) -> DataFrame:
    """Customers spending more than a share of the largest spender of four years."""
    worth = col("ss_quantity") * col("ss_sales_price")
    known = match(t.store_sales, t.customer.select("c_customer_sk"), "left_semi", ss_customer_sk="c_customer_sk")
    span = days(t, f"d_year between {year} and {year + 3}").select(col("d_date_sk").alias("span_day"))
    spent = materialized(match(known, span, "left", ss_sold_date_sk="span_day").groupBy("ss_customer_sk").agg(
        total(worth).alias("ssales"), total(F.when(col("span_day").isNotNull(), worth)).alias("csales")))
    most = spent.agg(F.max("csales").alias("cmax"))
    return spent.where(col("ssales") > most.scalar() * share).select(col("ss_customer_sk").alias("best_sk"))


def best_sales(t: Star, year: int, month: int, least: int, share: float) -> DataFrame:
    s = match(all_sales(t, "catalog", "web"), days(t, f"d_year = {year} and d_moy = {month}"), sold_date_sk="d_date_sk")
    s = match(s, frequent_items(t, year, least), "left_semi", item_sk="often_sk")
    s = match(s, best_customers(t, year, share), "left_semi", customer_sk="best_sk")
    return s.withColumn("sales", col("quantity") * col("list_price"))


@report
def q23(t: Star, year=1999, month=1, least=4, share=0.95) -> DataFrame:
    return best_sales(t, year, month, least, share).agg(total("sales").alias("sum_sales"))


@report
def q23b(t: Star, year=1999, month=1, least=4, share=0.95) -> DataFrame:
    s = match(best_sales(t, year, month, least, share), t.customer, customer_sk="c_customer_sk")
    out = s.groupBy("channel", "c_last_name", "c_first_name").agg(total("sales").alias("sales"))
    return leading(out.select("c_last_name", "c_first_name", "sales"), "c_last_name", "c_first_name", "sales")


def returned_purchases(t: Star, market: int, colour: str, share: float) -> DataFrame:
    s = match(t.store_sales, t.store_returns.select("sr_ticket_number", "sr_item_sk"),
              ss_ticket_number="sr_ticket_number", ss_item_sk="sr_item_sk")
    s = match(s, t.store.where(col("s_market_id") == market), ss_store_sk="s_store_sk")
    s = match(match(s, t.item, ss_item_sk="i_item_sk"), t.customer, ss_customer_sk="c_customer_sk")
    # a line counts once per address sharing the store's zip, so addresses are counted first
    homes = t.customer_address.groupBy("ca_zip", "ca_state", F.upper("ca_country").alias("ca_upper")).agg(
        F.count("*").alias("homes"))
    s = match(s, homes, s_zip="ca_zip", c_birth_country="ca_upper")
    # both the bar and the rows come from these groups
    paid = materialized(s.groupBy("c_last_name", "c_first_name", "s_store_name", "ca_state", "s_state", "i_color",
                     "i_current_price", "i_manager_id", "i_units", "i_size").agg(
        total(col("ss_sales_price") * col("homes")).alias("netpaid")))
    bar = paid.agg(mean("netpaid").alias("m")).scalar() * share
    out = paid.where(col("i_color") == colour).groupBy("c_last_name", "c_first_name", "s_store_name").agg(
        total("netpaid").alias("paid"))
    return out.where(col("paid") > bar)


@report
def q24(t: Star, market: int = 7, colour: str = "orchid", share: float = 0.05) -> DataFrame:
    return returned_purchases(t, market, colour, share)


@report
def q24b(t: Star, market: int = 7, colour: str = "chiffon", share: float = 0.05) -> DataFrame:
    return returned_purchases(t, market, colour, share)


@report
def q54(t: Star, category="Jewelry", item_class="consignment", month=3, year=1999) -> DataFrame:
    s = match(all_sales(t, "catalog", "web"), days(t, f"d_year = {year} and d_moy = {month}"), sold_date_sk="d_date_sk")
    wanted = t.item.where((col("i_category") == category) & (col("i_class") == item_class))
    buyers = match(s, wanted, "left_semi", item_sk="i_item_sk").select(col("customer_sk").alias("buyer"))
    mine = match(t.customer, buyers, "left_semi", c_customer_sk="buyer")
    # a sale counts once per store in the buyer's county
    near = t.store.groupBy("s_county", "s_state").agg(F.count("*").alias("stores"))
    mine = match(mine, t.customer_address, c_current_addr_sk="ca_address_sk")
    mine = match(mine, near, ca_county="s_county", ca_state="s_state").select("c_customer_sk", "stores")
    start = t.date_dim.where(f"d_year = {year} and d_moy = {month}").select("d_month_seq").distinct()
    later = t.date_dim.where(col("d_month_seq").between(start.scalar() + 1, start.scalar() + 3))
    r = match(match(t.store_sales, later, ss_sold_date_sk="d_date_sk"), mine, ss_customer_sk="c_customer_sk")
    revenue = r.groupBy("c_customer_sk").agg(total(col("ss_ext_sales_price") * col("stores")).alias("revenue"))
    out = revenue.groupBy(F.floor(col("revenue") / 50 + 0.5).alias("segment")).agg(F.count("*").alias("num_customers"))
    return leading(out.withColumn("segment_base", col("segment") * 50), "segment", "num_customers")


@report
def q64(t: Star, colours=("maroon", "burnished", "dim", "steel", "navajo", "chocolate"), price: float = 35,
        spread=(1, 10), year: int = 2000) -> DataFrame:
    """Items bought and returned at the same store in two successive years."""
    back = col("cr_refunded_cash") + col("cr_reversed_charge") + col("cr_store_credit")
    settled = match(t.catalog_sales, t.catalog_returns, cs_item_sk="cr_item_sk", cs_order_number="cr_order_number")
    settled = settled.groupBy(col("cs_item_sk").alias("ui_item_sk")).agg(
        total("cs_ext_list_price").alias("sale"), total(back).alias("refund")).where("sale > 2 * refund")
    items = t.item.where(col("i_color").isin(list(colours)) & col("i_current_price").between(price + spread[0], price + spread[1]))
    items = match(items, settled, "left_semi", i_item_sk="ui_item_sk")
    s = match(t.store_sales, items, ss_item_sk="i_item_sk")
    s = match(s, t.store_returns.select("sr_item_sk", "sr_ticket_number"), ss_item_sk="sr_item_sk",
              ss_ticket_number="sr_ticket_number")
    s = match(s, renamed(days(t, f"d_year in ({year}, {year + 1})"), "d_", "d1_"), ss_sold_date_sk="d1_date_sk")
    s = match(match(s, t.store, ss_store_sk="s_store_sk"), t.customer, ss_customer_sk="c_customer_sk")
    for key, p in (("c_first_sales_date_sk", "d2_"), ("c_first_shipto_date_sk", "d3_")):
        s = match(s, renamed(t.date_dim.select("d_date_sk", "d_year"), "d_", p), **{key: p + "date_sk"})
    people = t.customer_demographics.select("cd_demo_sk", "cd_marital_status")
    s = match(s, renamed(people, "cd_", "cd1_"), ss_cdemo_sk="cd1_demo_sk")
    s = match(s, renamed(people, "cd_", "cd2_"), c_current_cdemo_sk="cd2_demo_sk")
    s = s.where("cd1_marital_status <> cd2_marital_status")
    s = match(s, t.promotion.select("p_promo_sk"), "left_semi", ss_promo_sk="p_promo_sk")
    homes = match(t.household_demographics, t.income_band, "left_semi", hd_income_band_sk="ib_income_band_sk")
    s = match(s, homes, "left_semi", ss_hdemo_sk="hd_demo_sk")
    s = match(s, homes, "left_semi", c_current_hdemo_sk="hd_demo_sk")
    place = ["street_number", "street_name", "city", "zip"]
    for key, p in (("ss_addr_sk", "b_"), ("c_current_addr_sk", "c2_")):
        s = match(s, renamed(t.customer_address.select("ca_address_sk", *["ca_" + c for c in place]), "ca_", p),
                  **{key: p + "address_sk"})
    keys = ["i_product_name", "i_item_sk", "s_store_name", "s_zip", *["b_" + c for c in place],
            *["c2_" + c for c in place], "d1_year", "d2_year", "d3_year"]
    pairs = materialized(s.groupBy(*keys).agg(
        F.count("*").alias("cnt"), total("ss_wholesale_cost").alias("s1"), total("ss_list_price").alias("s2"),
        total("ss_coupon_amt").alias("s3")))
    first = pairs.where(f"d1_year = {year}").select(
        "i_item_sk", col("i_product_name").alias("product_name"), col("s_store_name").alias("store_name"),
        col("s_zip").alias("store_zip"), *["b_" + c for c in place], *[col("c2_" + c).alias("c_" + c) for c in place],
        col("d1_year").alias("syear"), "cnt", col("s1").alias("s11"), col("s2").alias("s21"), col("s3").alias("s31"))
    second = pairs.where(f"d1_year = {year + 1}").select(
        col("i_item_sk").alias("k_item"), col("s_store_name").alias("k_name"), col("s_zip").alias("k_zip"),
        col("s1").alias("s12"), col("s2").alias("s22"), col("s3").alias("s32"), col("d1_year").alias("syear2"),
        col("cnt").alias("cnt2"))
    out = match(first, second, i_item_sk="k_item", store_name="k_name", store_zip="k_zip").where("cnt2 <= cnt")
    return sorted_rows(out.drop("i_item_sk", "k_item", "k_name", "k_zip"), "product_name", "store_name", "cnt2")
