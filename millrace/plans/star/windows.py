"""Reports that rank, accumulate or compare rows within a group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from millrace.functions.money import mean, ratio, total
from millrace.operators.ranking import first_ranks, with_rank
from millrace.operators.relational import leading, match, sorted_rows, union_all, with_group
from millrace.plans.star.channels import CHANNELS, returns, sales
from millrace.plans.star.registry import report
from millrace.plans.star.simple import any_of, day_span, days
from millrace.plans.star.tables import Star
from millrace.session import materialized

col = F.col


def class_share(t: Star, channel: str, categories, start: str) -> DataFrame:
    """Revenue of each item and its percentage of the revenue of the class."""
    s = match(sales(t, channel), day_span(t, start, 30), sold_date_sk="d_date_sk")
    s = match(s, t.item.where(col("i_category").isin(list(categories))), item_sk="i_item_sk")
    keys = ["i_item_id", "i_item_desc", "i_category", "i_class", "i_current_price"]
    items = materialized(s.groupBy(*keys).agg(total("ext_sales_price").alias("itemrevenue")))
    out = with_group(items, ["i_class"], total("itemrevenue").alias("_class"))
    return out.select(*keys, "itemrevenue", (col("itemrevenue") * 100 / col("_class")).alias("revenueratio"))


SHARE_ORDER = ("i_category", "i_class", "i_item_id", "i_item_desc", "revenueratio")


@report
def q12(t: Star, categories=("Jewelry", "Sports", "Books"), start="2001-01-12") -> DataFrame:
    return leading(class_share(t, "web", categories, start), *SHARE_ORDER)


@report
def q20(t: Star, categories=("Jewelry", "Sports", "Books"), start="2001-01-12") -> DataFrame:
    return leading(class_share(t, "catalog", categories, start), *SHARE_ORDER)


@report
def q98(t: Star, categories=("Jewelry", "Sports", "Books"), start="2001-01-12") -> DataFrame:
    return sorted_rows(class_share(t, "store", categories, start), *SHARE_ORDER)


@report
def q44(t: Star, store: int = 50, k: int = 10) -> DataFrame:
    """Best and worst items of one store, paired by rank."""
    s = t.store_sales.where(col("ss_store_sk") == store)
    base = s.where("ss_hdemo_sk is null").agg(mean("ss_net_profit").alias("base"))
    items = s.groupBy(col("ss_item_sk").alias("item_sk")).agg(mean("ss_net_profit").alias("rank_col"))
    items = materialized(items.where(col("rank_col") > base.scalar() * 0.9))
    up = first_ranks(items, "rank_col", "rnk", k)
    down = first_ranks(items, "rank_col", "rnk", k, descending=True).select(
        col("rnk").alias("rnk2"), col("item_sk").alias("item2"))
    both = match(up, down, rnk="rnk2")
    names = t.item.select("i_item_sk", "i_product_name")
    both = match(both, names.toDF("k1", "best_performing"), item_sk="k1")
    both = match(both, names.toDF("k2", "worst_performing"), item2="k2")
    return leading(both.select("rnk", "best_performing", "worst_performing"), "rnk")


def return_ratios(t: Star, channel: str, year: int, month: int, least: float) -> DataFrame:
    """Returned share of quantity and amount per item."""
    s = sales(t, channel).where("net_profit > 1 and net_paid > 0 and quantity > 0")
    s = match(s, days(t, f"d_year = {year} and d_moy = {month}"), sold_date_sk="d_date_sk")
    r = returns(t, channel).where(col("return_amt") > least)
    s = match(s, r, order_no="r_order_no", item_sk="r_item_sk")
    return s.groupBy(F.lit(channel).alias("channel"), col("item_sk").alias("item")).agg(
        (F.sum(F.coalesce("return_quantity", F.lit(0))) / F.sum("quantity")).alias("return_ratio"),
        (total(F.coalesce("return_amt", F.lit(0.0))) / total("net_paid")).alias("currency_ratio"))


@report
def q49(t: Star, year: int = 2000, month: int = 12, least: float = 10000, k: int = 10) -> DataFrame:
    items = materialized(union_all(*[return_ratios(t, c, year, month, least) for c in CHANNELS]))
    items = with_rank(items, "return_ratio", "return_rank", ["channel"])
    items = with_rank(items, "currency_ratio", "currency_rank", ["channel"])
    out = items.where((col("return_rank") <= k) | (col("currency_rank") <= k)).select(
        "channel", "item", "return_ratio", "return_rank", "currency_rank").distinct()
    return leading(out, "channel", "return_rank", "currency_rank")


def monthly_outliers(t: Star, fact: DataFrame, outlet_keys: list[str], amount: str, year: int,
                     kept: list[str]) -> DataFrame:
    """Months more than 10 % off the yearly mean, with the month before and after."""
    group = ["i_category", "i_brand"] + outlet_keys
    months = fact.groupBy(*group, "d_year", "d_moy").agg(total(amount).alias("sum_sales")).where(
        " and ".join(f"{g} is not null" for g in group))
    # one row per month: at most fourteen rows per group
    by_month = W.partitionBy(*group).orderBy("d_year", "d_moy")
    year_of = W.partitionBy(*group, "d_year")
    months = months.select(
        "*", (F.round(F.sum("sum_sales").over(year_of), 2) / F.count("sum_sales").over(year_of)).alias("avg_monthly_sales"),
        F.lag("sum_sales").over(by_month).alias("psum"), F.lead("sum_sales").over(by_month).alias("nsum"),
        F.row_number().over(by_month).alias("pos"), F.count("*").over(W.partitionBy(*group)).alias("size"))
    months = months.where("pos > 1 and pos < size").where((col("d_year") == year) & (col("avg_monthly_sales") > 0))
    off = F.abs(col("sum_sales") - col("avg_monthly_sales"))
    months = months.where(ratio(off, "avg_monthly_sales") > 0.1)
    cols = kept + ["d_year", "d_moy", "avg_monthly_sales", "sum_sales", "psum", "nsum"]
    out = months.withColumn("gap", col("sum_sales") - col("avg_monthly_sales")).select(*cols, "gap")
    return leading(out, "gap", "d_moy").drop("gap")


def around_year(t: Star, year: int) -> DataFrame:
    return days(t, f"d_year = {year} or (d_year = {year - 1} and d_moy = 12) or (d_year = {year + 1} and d_moy = 1)")


@report
def q47(t: Star, year: int = 2000) -> DataFrame:
    s = match(t.store_sales, around_year(t, year), ss_sold_date_sk="d_date_sk")
    s = match(match(s, t.item, ss_item_sk="i_item_sk"), t.store, ss_store_sk="s_store_sk")
    return monthly_outliers(t, s, ["s_store_name", "s_company_name"], "ss_sales_price", year, ["i_category"])


@report
def q57(t: Star, year: int = 2000) -> DataFrame:
    s = match(t.catalog_sales, around_year(t, year), cs_sold_date_sk="d_date_sk")
    s = match(match(s, t.item, cs_item_sk="i_item_sk"), t.call_center, cs_call_center_sk="cc_call_center_sk")
    return monthly_outliers(t, s, ["cc_name"], "cs_sales_price", year, ["i_category", "i_brand"])


# (categories, classes, brands) of the two deviation reports (fixed values)
PRODUCT_LINES = (
    (("Books", "Children", "Electronics"), ("personal", "portable", "reference", "self-help"),
     ("scholaramalgamalg #14", "scholaramalgamalg #7", "exportiunivamalg #9", "scholaramalgamalg #9")),
    (("Women", "Music", "Men"), ("accessories", "classical", "fragrances", "pants"),
     ("amalgimporto #1", "edu packscholar #1", "exportiimporto #1", "importoamalg #1")),
)


def deviating(t: Star, key: str, period: str, mean_name: str, month: int, lines) -> DataFrame:
    wanted = any_of([col("i_category").isin(list(c)) & col("i_class").isin(list(k)) & col("i_brand").isin(list(b))
                     for c, k, b in lines])
    s = match(t.store_sales, days(t, f"d_month_seq between {month} and {month + 11}"), ss_sold_date_sk="d_date_sk")
    s = match(match(s, t.item.where(wanted), ss_item_sk="i_item_sk"), t.store.select("s_store_sk"),
              ss_store_sk="s_store_sk")
    sums = materialized(s.groupBy(key, period).agg(total("ss_sales_price").alias("sum_sales")))
    out = with_group(sums, [key], mean("sum_sales").alias(mean_name))
    return out.where(ratio(F.abs(col("sum_sales") - col(mean_name)), mean_name) > 0.1).select(
        key, "sum_sales", mean_name)


@report
def q53(t: Star, month: int = 1212, lines=PRODUCT_LINES) -> DataFrame:
    out = deviating(t, "i_manufact_id", "d_qoy", "avg_quarterly_sales", month, lines)
    return leading(out, "avg_quarterly_sales", "sum_sales", "i_manufact_id")


@report
def q63(t: Star, month: int = 1212, lines=PRODUCT_LINES) -> DataFrame:
    out = deviating(t, "i_manager_id", "d_moy", "avg_monthly_sales", month, lines)
    return leading(out, "i_manager_id", "avg_monthly_sales", "sum_sales")


@report
def q89(t: Star, year: int = 2000,
        lines=((("Home", "Books", "Electronics"), ("wallpaper", "parenting", "musical")),
               (("Shoes", "Jewelry", "Men"), ("womens", "birdal", "pants")))) -> DataFrame:
    wanted = any_of([col("i_category").isin(list(c)) & col("i_class").isin(list(k)) for c, k in lines])
    s = match(t.store_sales, days(t, f"d_year = {year}"), ss_sold_date_sk="d_date_sk")
    s = match(match(s, t.item.where(wanted), ss_item_sk="i_item_sk"), t.store, ss_store_sk="s_store_sk")
    keys = ["i_category", "i_class", "i_brand", "s_store_name", "s_company_name", "d_moy"]
    sums = materialized(s.groupBy(*keys).agg(total("ss_sales_price").alias("sum_sales")))
    out = with_group(sums, ["i_category", "i_brand", "s_store_name", "s_company_name"],
                     mean("sum_sales").alias("avg_monthly_sales"))
    off = F.abs(col("sum_sales") - col("avg_monthly_sales"))
    out = out.where(F.when(col("avg_monthly_sales") != 0, off / col("avg_monthly_sales")) > 0.1)
    out = out.select(*keys, "sum_sales", "avg_monthly_sales", (col("sum_sales") - col("avg_monthly_sales")).alias("gap"))
    return leading(out, "gap", "s_store_name").drop("gap")


@report
def q51(t: Star, month: int = 1212) -> DataFrame:
    """Days on which the web total of an item, accumulated, leads the store total."""
    # one row per item and day: the windows are bounded by the days of a year
    so_far = W.partitionBy("item_sk").orderBy("d_date").rowsBetween(W.unboundedPreceding, 0)

    def running(channel: str, name: str) -> DataFrame:
        s = match(sales(t, channel).where("item_sk is not null"),
                  days(t, f"d_month_seq between {month} and {month + 11}"), sold_date_sk="d_date_sk")
        daily = s.groupBy("item_sk", "d_date").agg(total("sales_price").alias("day_sales"))
        return daily.select("item_sk", "d_date", F.round(F.sum("day_sales").over(so_far), 2).alias(name))

    both = running("web", "web_sales").join(running("store", "store_sales"), ["item_sk", "d_date"], "full")
    both = both.select("*", F.max("web_sales").over(so_far).alias("web_cumulative"),
                       F.max("store_sales").over(so_far).alias("store_cumulative"))
    return leading(both.where("web_cumulative > store_cumulative"), "item_sk", "d_date")
