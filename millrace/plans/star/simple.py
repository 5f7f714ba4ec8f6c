"""Star joins with one level of grouping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.money import mean, total
from millrace.operators.relational import leading, match, renamed, sorted_rows
from millrace.plans.star.channels import sales
from millrace.plans.star.registry import report
from millrace.plans.star.tables import Star

col = F.col


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def days(t: Star, condition: str) -> DataFrame:
    return t.date_dim.where(condition)


def day_span(t: Star, start: str, length: int) -> DataFrame:
    """Calendar days from ``start`` to ``start + length`` inclusive."""
    first = F.lit(start).cast("date")
    return t.date_dim.where(col("d_date").between(first, F.date_add(first, length)))


def stock_on(t: Star, dates: DataFrame) -> DataFrame:
    """Stock on the given days; the semi join gets below the grouping of a derived inventory."""
    some = match(t.inventory, dates.select(col("d_date_sk").alias("stock_day")), "left_semi", inv_date_sk="stock_day")
    return match(some, dates, inv_date_sk="d_date_sk")


def brand_revenue(t: Star, item_filter: str, date_filter: str) -> DataFrame:
    s = match(sales(t, "store"), days(t, date_filter), sold_date_sk="d_date_sk")
    return match(s, t.item.where(item_filter), item_sk="i_item_sk")


@report
def q3(t: Star, manufact: int = 436, month: int = 12) -> DataFrame:
    s = brand_revenue(t, f"i_manufact_id = {manufact}", f"d_moy = {month}")
    out = s.groupBy("d_year", col("i_brand_id").alias("brand_id"), col("i_brand").alias("brand")).agg(
        total("ext_sales_price").alias("sum_agg"))
    return leading(out, "d_year", "-sum_agg", "brand_id")


@report
def q52(t: Star, manager: int = 1, year: int = 1998, month: int = 12) -> DataFrame:
    s = brand_revenue(t, f"i_manager_id = {manager}", f"d_moy = {month} and d_year = {year}")
    out = s.groupBy("d_year", col("i_brand_id").alias("brand_id"), col("i_brand").alias("brand")).agg(
        total("ext_sales_price").alias("ext_price"))
    return leading(out, "d_year", "-ext_price", "brand_id")


@report
def q55(t: Star, manager: int = 36, year: int = 2001, month: int = 12) -> DataFrame:
    s = brand_revenue(t, f"i_manager_id = {manager}", f"d_moy = {month} and d_year = {year}")
    out = s.groupBy(col("i_brand_id").alias("brand_id"), col("i_brand").alias("brand")).agg(
        total("ext_sales_price").alias("ext_price"))
    return leading(out, "-ext_price", "brand_id")


@report
def q42(t: Star, manager: int = 1, year: int = 1998, month: int = 12) -> DataFrame:
    s = brand_revenue(t, f"i_manager_id = {manager}", f"d_moy = {month} and d_year = {year}")
    out = s.groupBy("d_year", "i_category_id", "i_category").agg(
        total("ext_sales_price").alias("total_sales"))
    return leading(out, "-total_sales", "d_year", "i_category_id", "i_category")


def promoted_item_means(t: Star, fact: DataFrame, p: str, cdemo: str, gender: str, marital: str,
                        education: str, year: int) -> DataFrame:
    people = t.customer_demographics.where(
        (col("cd_gender") == gender) & (col("cd_marital_status") == marital)
        & (col("cd_education_status") == education))
    promo = t.promotion.where("p_channel_email = 'N' or p_channel_event = 'N'")
    s = match(fact, people, **{p + cdemo: "cd_demo_sk"})
    s = match(s, days(t, f"d_year = {year}"), **{p + "sold_date_sk": "d_date_sk"})
    s = match(match(s, promo, **{p + "promo_sk": "p_promo_sk"}), t.item, **{p + "item_sk": "i_item_sk"})
    out = s.groupBy("i_item_id").agg(
        F.avg(p + "quantity").alias("agg1"), mean(p + "list_price").alias("agg2"),
        mean(p + "coupon_amt").alias("agg3"), mean(p + "sales_price").alias("agg4"))
    return leading(out, "i_item_id")


@report
def q7(t: Star, gender="F", marital="W", education="Primary", year=1998) -> DataFrame:
    return promoted_item_means(t, t.store_sales, "ss_", "cdemo_sk", gender, marital, education, year)


@report
def q26(t: Star, gender="F", marital="W", education="Primary", year=1998) -> DataFrame:
    return promoted_item_means(t, t.catalog_sales, "cs_", "bill_cdemo_sk", gender, marital, education, year)


def area_bands(bands: list[tuple], profit: str, country: str) -> Column:
    """Each band: (states, low, high) on the buyer's address and the profit."""
    return (col("ca_country") == country) & any_of(
        [col("ca_state").isin(list(states)) & col(profit).between(lo, hi) for states, lo, hi in bands])


@report
def q13(t: Star, year: int = 2001, country: str = "United States",
        people: tuple = (("D", "2 yr Degree", 100, 150, 3), ("S", "Secondary", 50, 100, 1),
                         ("W", "Advanced Degree", 150, 200, 1)),
        areas: tuple = ((("CO", "IL", "MN"), 100, 200), (("OH", "MT", "NM"), 150, 300),
                        (("TX", "MO", "MI"), 50, 250))) -> DataFrame:
    s = match(t.store_sales, t.store.select("s_store_sk"), ss_store_sk="s_store_sk")
    s = match(s, days(t, f"d_year = {year}"), ss_sold_date_sk="d_date_sk")
    s = match(s, t.customer_demographics, ss_cdemo_sk="cd_demo_sk")
    s = match(s, t.household_demographics, ss_hdemo_sk="hd_demo_sk")
    s = match(s, t.customer_address, ss_addr_sk="ca_address_sk")
    band = any_of([(col("cd_marital_status") == m) & (col("cd_education_status") == e)
                   & col("ss_sales_price").between(lo, hi) & (col("hd_dep_count") == dep)
                   for m, e, lo, hi, dep in people])
    return s.where(band & area_bands(areas, "ss_net_profit", country)).agg(
        F.avg("ss_quantity").alias("avg_quantity"),
        mean("ss_ext_sales_price").alias("avg_sales_price"),
        mean("ss_ext_wholesale_cost").alias("avg_wholesale_cost"),
        total("ss_ext_wholesale_cost").alias("sum_wholesale_cost"))


@report
def q48(t: Star, year: int = 1998, country: str = "United States",
        people: tuple = (("M", "4 yr Degree", 100, 150), ("D", "Primary", 50, 100),
                         ("U", "Advanced Degree", 150, 200)),
        areas: tuple = ((("KY", "GA", "NM"), 0, 2000), (("MT", "OR", "IN"), 150, 3000),
                        (("WI", "MO", "WV"), 50, 25000))) -> DataFrame:
    s = match(t.store_sales, t.store.select("s_store_sk"), ss_store_sk="s_store_sk")
    s = match(s, days(t, f"d_year = {year}"), ss_sold_date_sk="d_date_sk")
    s = match(s, t.customer_demographics, ss_cdemo_sk="cd_demo_sk")
    s = match(s, t.customer_address, ss_addr_sk="ca_address_sk")
    band = any_of([(col("cd_marital_status") == m) & (col("cd_education_status") == e)
                   & col("ss_sales_price").between(lo, hi) for m, e, lo, hi in people])
    return s.where(band & area_bands(areas, "ss_net_profit", country)).agg(
        F.sum("ss_quantity").alias("sum_quantity"))


@report
def q85(t: Star, year: int = 1998, country: str = "United States",
        people: tuple = (("M", "4 yr Degree", 100, 150), ("D", "Primary", 50, 100),
                         ("U", "Advanced Degree", 150, 200)),
        areas: tuple = ((("KY", "GA", "NM"), 100, 200), (("MT", "OR", "IN"), 150, 300),
                        (("WI", "MO", "WV"), 50, 250))) -> DataFrame:
    buyer = renamed(t.customer_demographics, "cd_", "cd1_")
    sender = renamed(t.customer_demographics, "cd_", "cd2_")
    s = match(t.web_sales, days(t, f"d_year = {year}"), ws_sold_date_sk="d_date_sk")
    s = match(s, t.web_page.select("wp_web_page_sk"), ws_web_page_sk="wp_web_page_sk")
    s = match(s, t.web_returns, ws_item_sk="wr_item_sk", ws_order_number="wr_order_number")
    s = match(s, buyer, wr_refunded_cdemo_sk="cd1_demo_sk")
    s = match(s, sender, wr_returning_cdemo_sk="cd2_demo_sk",
              cd1_marital_status="cd2_marital_status", cd1_education_status="cd2_education_status")
    s = match(s, t.customer_address, wr_refunded_addr_sk="ca_address_sk")
    s = match(s, t.reason, wr_reason_sk="r_reason_sk")
    band = any_of([(col("cd1_marital_status") == m) & (col("cd1_education_status") == e)
                   & col("ws_sales_price").between(lo, hi) for m, e, lo, hi in people])
    out = (s.where(band & area_bands(areas, "ws_net_profit", country))
           .groupBy("r_reason_desc").agg(F.avg("ws_quantity").alias("avg_quantity"),
                                         mean("wr_refunded_cash").alias("avg_refunded"),
                                         mean("wr_fee").alias("avg_fee"))
           .select(F.substring("r_reason_desc", 1, 20).alias("reason"),
                   "avg_quantity", "avg_refunded", "avg_fee"))
    return leading(out, "reason", "avg_quantity", "avg_refunded", "avg_fee")


# zip codes watched by two of the reports (fixed values)
WATCHED_ZIPS = ("85669", "86197", "88274", "83405", "86475", "85392", "85460", "80348", "81792")


@report
def q15(t: Star, zips=WATCHED_ZIPS, states=("CA", "WA", "GA"), price=500, quarter=2, year=2000) -> DataFrame:
    s = match(t.catalog_sales, days(t, f"d_qoy = {quarter} and d_year = {year}"),
              cs_sold_date_sk="d_date_sk")
    s = match(s, t.customer, cs_bill_customer_sk="c_customer_sk")
    s = match(s, t.customer_address, c_current_addr_sk="ca_address_sk")
    kept = (F.substring("ca_zip", 1, 5).isin(list(zips)) | col("ca_state").isin(list(states))
            | (col("cs_sales_price") > price))
    return leading(s.where(kept).groupBy("ca_zip").agg(total("cs_sales_price").alias("total_price")), "ca_zip")


@report
def q45(t: Star, zips=WATCHED_ZIPS, items=(2, 3, 5, 7, 11, 13, 17, 19, 23, 29), quarter=2,
        year=2000) -> DataFrame:
    listed = t.item.where(col("i_item_sk").isin(list(items))).select(
        col("i_item_id").alias("listed_id")).distinct()
    s = match(t.web_sales, days(t, f"d_qoy = {quarter} and d_year = {year}"), ws_sold_date_sk="d_date_sk")
    s = match(s, t.customer, ws_bill_customer_sk="c_customer_sk")
    s = match(s, t.customer_address, c_current_addr_sk="ca_address_sk")
    s = match(s, match(t.item, listed, "left", i_item_id="listed_id"), ws_item_sk="i_item_sk")
    kept = F.substring("ca_zip", 1, 5).isin(list(zips)) | col("listed_id").isNotNull()
    out = s.where(kept).groupBy("ca_zip", "ca_county").agg(total("ws_sales_price").alias("total_price"))
    return leading(out, "ca_zip", "ca_county")


@report
def q19(t: Star, manager: int = 7, month: int = 11, year: int = 1999) -> DataFrame:
    s = brand_revenue(t, f"i_manager_id = {manager}", f"d_moy = {month} and d_year = {year}")
    s = match(s, t.customer, customer_sk="c_customer_sk")
    s = match(s, t.customer_address, c_current_addr_sk="ca_address_sk")
    s = match(s, t.store, outlet_sk="s_store_sk")
    away = F.substring("ca_zip", 1, 5) != F.substring("s_zip", 1, 5)
    out = s.where(away).groupBy(
        col("i_brand_id").alias("brand_id"), col("i_brand").alias("brand"), "i_manufact_id", "i_manufact"
    ).agg(total("ext_sales_price").alias("ext_price"))
    return leading(out, "-ext_price", "brand", "brand_id", "i_manufact_id", "i_manufact")


def sold_returned_rebought(t: Star, sold: str, returned: str, rebought: str) -> DataFrame:
    """Store sales followed by their return and a catalog purchase by the same customer."""
    roles = [renamed(days(t, cond), "d_", p) for cond, p in
             ((sold, "d1_"), (returned, "d2_"), (rebought, "d3_"))]
    s = match(t.store_sales, roles[0], ss_sold_date_sk="d1_date_sk")
    r = match(t.store_returns, roles[1], sr_returned_date_sk="d2_date_sk")
    c = match(t.catalog_sales, roles[2], cs_sold_date_sk="d3_date_sk")
    s = match(s, r, ss_ticket_number="sr_ticket_number", ss_item_sk="sr_item_sk",
              ss_customer_sk="sr_customer_sk")
    s = match(s, c, sr_customer_sk="cs_bill_customer_sk", sr_item_sk="cs_item_sk")
    return match(match(s, t.store, ss_store_sk="s_store_sk"), t.item, ss_item_sk="i_item_sk")


@report
def q17(t: Star, first: str = "1998Q1", later=("1998Q1", "1998Q2", "1998Q3")) -> DataFrame:
    names = ", ".join(f"'{q}'" for q in later)
    s = sold_returned_rebought(t, f"d_quarter_name = '{first}'", f"d_quarter_name in ({names})",
                               f"d_quarter_name in ({names})")
    aggs = []
    for c, name in (("ss_quantity", "store_sales_quantity"), ("sr_return_quantity", "store_returns_quantity"),
                    ("cs_quantity", "catalog_sales_quantity")):
        spread = F.stddev_samp(c)
        aggs += [F.count(c).alias(name + "count"), F.avg(c).alias(name + "ave"),
                 F.round(spread, 6).alias(name + "stdev"),
                 F.round(spread / F.avg(c), 6).alias(name + "cov")]
    return leading(s.groupBy("i_item_id", "i_item_desc", "s_state").agg(*aggs),
                   "i_item_id", "i_item_desc", "s_state")


@report
def q25(t: Star, year: int = 2000, first: int = 4, last: int = 10) -> DataFrame:
    later = f"d_moy between {first} and {last} and d_year = {year}"
    s = sold_returned_rebought(t, f"d_moy = {first} and d_year = {year}", later, later)
    out = s.groupBy("i_item_id", "i_item_desc", "s_store_id", "s_store_name").agg(
        total("ss_net_profit").alias("store_sales_profit"), total("sr_net_loss").alias("store_returns_loss"),
        total("cs_net_profit").alias("catalog_sales_profit"))
    return leading(out, "i_item_id", "i_item_desc", "s_store_id", "s_store_name")


@report
def q29(t: Star, year: int = 1999, month: int = 4, window: int = 3, years: int = 2) -> DataFrame:
    s = sold_returned_rebought(
        t, f"d_moy = {month} and d_year = {year}",
        f"d_moy between {month} and {month + window} and d_year = {year}",
        f"d_year between {year} and {year + years}")
    out = s.groupBy("i_item_id", "i_item_desc", "s_store_id", "s_store_name").agg(
        F.sum("ss_quantity").alias("store_sales_quantity"),
        F.sum("sr_return_quantity").alias("store_returns_quantity"),
        F.sum("cs_quantity").alias("catalog_sales_quantity"))
    return leading(out, "i_item_id", "i_item_desc", "s_store_id", "s_store_name")


def stocked_and_sold(t: Star, fact_items: DataFrame, price: float, makers, start: str) -> DataFrame:
    """Items in a price band that were in stock in the window and ever sold."""
    stock = stock_on(t, day_span(t, start, 60)).where(col("inv_quantity_on_hand").between(100, 500))
    items = t.item.where(col("i_current_price").between(price, price + 30)
                         & col("i_manufact_id").isin(list(makers)))
    kept = match(items, stock, "left_semi", i_item_sk="inv_item_sk")
    kept = kept.join(fact_items, col("i_item_sk") == col("sold_item_sk"), "left_semi")
    return leading(kept.select("i_item_id", "i_item_desc", "i_current_price").distinct(), "i_item_id")


@report
def q37(t: Star, price=22, makers=(678, 964, 918, 849), start="2001-06-02") -> DataFrame:
    return stocked_and_sold(t, t.catalog_sales.select(col("cs_item_sk").alias("sold_item_sk")),
                            price, makers, start)


@report
def q82(t: Star, price=30, makers=(437, 129, 727, 663), start="2002-05-30") -> DataFrame:
    return stocked_and_sold(t, t.store_sales.select(col("ss_item_sk").alias("sold_item_sk")),
                            price, makers, start)


DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def by_weekday(amount: str) -> list[Column]:
    return [total(F.when(col("d_day_name") == d, col(amount))).alias(d[:3].lower() + "_sales")
            for d in DAY_NAMES]


@report
def q43(t: Star, offset: float = -6, year: int = 1998) -> DataFrame:
    s = match(t.store_sales, days(t, f"d_year = {year}"), ss_sold_date_sk="d_date_sk")
    s = match(s, t.store.where(col("s_gmt_offset") == offset), ss_store_sk="s_store_sk")
    out = s.groupBy("s_store_name", "s_store_id").agg(*by_weekday("ss_sales_price"))
    return leading(out, "s_store_name", "s_store_id")


def lag_buckets(lag: Column) -> list[Column]:
    """Row counts by days elapsed: up to 30, 31-60, 61-90, 91-120 and more."""
    bounds = [(None, 30, "days_30"), (30, 60, "days_31_60"), (60, 90, "days_61_90"),
              (90, 120, "days_91_120"), (120, None, "days_gt120")]
    out = []
    for lo, hi, name in bounds:
        inside = F.lit(True)
        if lo is not None:
            inside = inside & (lag > lo)
        if hi is not None:
            inside = inside & (lag <= hi)
        out.append(F.count_if(inside).alias(name))
    return out


@report
def q50(t: Star, year: int = 2000, month: int = 9) -> DataFrame:
    r = match(t.store_returns, days(t, f"d_year = {year} and d_moy = {month}"),
              sr_returned_date_sk="d_date_sk")
    s = match(t.store_sales, r, ss_ticket_number="sr_ticket_number", ss_item_sk="sr_item_sk",
              ss_customer_sk="sr_customer_sk")
    s = match(s, renamed(t.date_dim.select("d_date_sk"), "d_", "d1_"), ss_sold_date_sk="d1_date_sk")
    s = match(s, t.store, ss_store_sk="s_store_sk")
    keys = ["s_store_name", "s_company_id", "s_street_number", "s_street_name", "s_street_type",
            "s_suite_number", "s_city", "s_county", "s_state", "s_zip"]
    out = s.groupBy(*keys).agg(*lag_buckets(col("sr_returned_date_sk") - col("ss_sold_date_sk")))
    return leading(out, *keys)


def shipping_lag(t: Star, fact: DataFrame, p: str, outlet: DataFrame, outlet_keys: dict, name: str,
                 month: int) -> DataFrame:
    s = match(fact, days(t, f"d_month_seq between {month} and {month + 11}"),
              **{p + "ship_date_sk": "d_date_sk"})
    s = match(s, t.warehouse, **{p + "warehouse_sk": "w_warehouse_sk"})
    s = match(s, t.ship_mode, **{p + "ship_mode_sk": "sm_ship_mode_sk"})
    s = match(s, outlet, **outlet_keys)
    place = F.substring("w_warehouse_name", 1, 20).alias("w_warehouse_name_substr")
    out = s.groupBy(place, "sm_type", name).agg(
        *lag_buckets(col(p + "ship_date_sk") - col(p + "sold_date_sk")))
    return leading(out, "w_warehouse_name_substr", "sm_type", name)


@report
def q62(t: Star, month: int = 1212) -> DataFrame:
    return shipping_lag(t, t.web_sales, "ws_", t.web_site, {"ws_web_site_sk": "web_site_sk"}, "web_name", month)


@report
def q99(t: Star, month: int = 1212) -> DataFrame:
    return shipping_lag(t, t.catalog_sales, "cs_", t.call_center,
                        {"cs_call_center_sk": "cc_call_center_sk"}, "cc_name", month)


@report
def q61(t: Star, offset=-7, category="Books", year=1999, month=11) -> DataFrame:
    """Promoted and total revenue in one pass over the sales."""
    s = match(t.store_sales, days(t, f"d_year = {year} and d_moy = {month}"), ss_sold_date_sk="d_date_sk")
    s = match(s, t.store.where(col("s_gmt_offset") == offset), ss_store_sk="s_store_sk")
    s = match(s, t.item.where(col("i_category") == category), ss_item_sk="i_item_sk")
    s = match(s, t.customer, ss_customer_sk="c_customer_sk")
    s = match(s, t.customer_address.where(col("ca_gmt_offset") == offset), c_current_addr_sk="ca_address_sk")
    promo = t.promotion.where("p_channel_dmail = 'Y' or p_channel_email = 'Y' or p_channel_tv = 'Y'")
    s = match(s, promo, "left", ss_promo_sk="p_promo_sk")
    price = col("ss_ext_sales_price")
    out = s.agg(total(F.when(col("p_promo_sk").isNotNull(), price)).alias("promotions"),
                total(price).alias("total"))
    return out.withColumn("share", F.when(col("total") != 0, col("promotions") / col("total") * 100))


@report
def q79(t: Star, dep: int = 8, dow: int = 1, year: int = 1998, staff=(200, 295)) -> DataFrame:
    s = match(t.store_sales, days(t, f"d_dow = {dow} and d_year between {year} and {year + 2}"),
              ss_sold_date_sk="d_date_sk")
    s = match(s, t.store.where(col("s_number_employees").between(*staff)), ss_store_sk="s_store_sk")
    s = match(s, t.household_demographics.where(f"hd_dep_count = {dep} or hd_vehicle_count > 0"),
              ss_hdemo_sk="hd_demo_sk")
    tickets = s.groupBy("ss_ticket_number", "ss_customer_sk", "ss_addr_sk", "s_city").agg(
        total("ss_coupon_amt").alias("amt"), total("ss_net_profit").alias("profit"))
    out = match(tickets, t.customer, ss_customer_sk="c_customer_sk").select(
        "c_last_name", "c_first_name", F.substring("s_city", 1, 30).alias("city"), "ss_ticket_number",
        "amt", "profit")
    return leading(out, "c_last_name", "c_first_name", "city", "profit")


@report
def q84(t: Star, city: str = "Hopewell", income: int = 32287, n: int = 100) -> DataFrame:
    """One row per return that shares the customer's demographics.

    Returns are counted per demographic first; a customer then needs at most
    ``n`` copies, because the report itself ends after ``n`` rows.
    """
    bands = t.income_band.where(f"ib_lower_bound >= {income} and ib_upper_bound <= {income + 50000}")
    homes = match(t.household_demographics, bands, "left_semi", hd_income_band_sk="ib_income_band_sk")
    people = match(t.customer, t.customer_address.where(col("ca_city") == city),
                   c_current_addr_sk="ca_address_sk")
    people = match(people, homes, c_current_hdemo_sk="hd_demo_sk")
    people = match(people, t.customer_demographics, c_current_cdemo_sk="cd_demo_sk")
    counts = t.store_returns.groupBy("sr_cdemo_sk").agg(F.count("*").alias("copies"))
    named = F.concat(F.coalesce("c_last_name", F.lit("")), F.lit(", "), F.coalesce("c_first_name", F.lit("")))
    out = match(people, counts, cd_demo_sk="sr_cdemo_sk").select(
        col("c_customer_id").alias("customer_id"), named.alias("customername"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.least("copies", F.lit(n).cast("bigint")))).alias("copy"))
    return leading(out.drop("copy"), "customer_id", n=n)


@report
def q88(t: Star, store: str = "ese", dependants=(3, 0, 1)) -> DataFrame:
    """Eight half-hour counts in one pass."""
    homes = any_of([(col("hd_dep_count") == d) & (col("hd_vehicle_count") <= d + 2) for d in dependants])
    s = match(t.store_sales, t.household_demographics.where(homes), ss_hdemo_sk="hd_demo_sk")
    s = match(s, t.store.where(col("s_store_name") == store), ss_store_sk="s_store_sk")
    s = match(s, t.time_dim.where("t_hour between 8 and 12"), ss_sold_time_sk="t_time_sk")
    names = ("h8_30_to_9", "h9_to_9_30", "h9_30_to_10", "h10_to_10_30", "h10_30_to_11", "h11_to_11_30",
             "h11_30_to_12", "h12_to_12_30")
    half = col("t_hour") * 2 + F.when(col("t_minute") >= 30, 1).otherwise(0) - 17
    return s.agg(*[F.count_if(half == i).alias(n) for i, n in enumerate(names)])


@report
def q96(t: Star, store: str = "ese", dep: int = 5, hour: int = 8) -> DataFrame:
    s = match(t.store_sales, t.household_demographics.where(f"hd_dep_count = {dep}"), ss_hdemo_sk="hd_demo_sk")
    s = match(s, t.store.where(col("s_store_name") == store), ss_store_sk="s_store_sk")
    s = match(s, t.time_dim.where(f"t_hour = {hour} and t_minute >= 30"), ss_sold_time_sk="t_time_sk")
    return s.agg(F.count("*").alias("cnt"))


@report
def q90(t: Star, dep: int = 8, morning: int = 6, evening: int = 14, chars=(5000, 5200)) -> DataFrame:
    s = match(t.web_sales, t.household_demographics.where(f"hd_dep_count = {dep}"),
              ws_ship_hdemo_sk="hd_demo_sk")
    s = match(s, t.web_page.where(col("wp_char_count").between(*chars)), ws_web_page_sk="wp_web_page_sk")
    s = match(s, t.time_dim, ws_sold_time_sk="t_time_sk")
    early, late = (col("t_hour").between(h, h + 1) for h in (morning, evening))
    counts = s.agg(F.count_if(early).alias("amc"), F.count_if(late).alias("pmc"))
    return counts.select(F.when(col("pmc") > 0, col("amc") / col("pmc")).alias("am_pm_ratio"))


@report
def q91(t: Star, year: int = 1999, month: int = 11, offset: float = -7, potential: str = "0-500%",
        people=(("M", "Unknown"), ("W", "Advanced Degree"))) -> DataFrame:
    r = match(t.catalog_returns, days(t, f"d_year = {year} and d_moy = {month}"),
              cr_returned_date_sk="d_date_sk")
    r = match(r, t.call_center, cr_call_center_sk="cc_call_center_sk")
    r = match(r, t.customer, cr_returning_customer_sk="c_customer_sk")
    kinds = any_of([(col("cd_marital_status") == m) & (col("cd_education_status") == e) for m, e in people])
    r = match(r, t.customer_demographics.where(kinds), c_current_cdemo_sk="cd_demo_sk")
    r = match(r, t.household_demographics.where(col("hd_buy_potential").like(potential)),
              c_current_hdemo_sk="hd_demo_sk")
    r = match(r, t.customer_address.where(col("ca_gmt_offset") == offset), c_current_addr_sk="ca_address_sk")
    out = (r.groupBy("cc_call_center_id", "cc_name", "cc_manager", "cd_marital_status", "cd_education_status")
           .agg(total("cr_net_loss").alias("returns_loss"))
           .select(col("cc_call_center_id").alias("call_center"), col("cc_name").alias("call_center_name"),
                   col("cc_manager").alias("manager"), "returns_loss"))
    return sorted_rows(out, "-returns_loss")
