"""Reports with subtotals over a hierarchy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.functions.money import mean, total
from millrace.operators.ranking import with_rank
from millrace.operators.relational import leading, match, ordering, union_all
from millrace.plans.star.channels import CHANNELS, all_sales, returns, sales
from millrace.plans.star.registry import report
from millrace.plans.star.simple import day_span, days, stock_on
from millrace.plans.star.tables import Star
from millrace.session import materialized

col = F.col

# channel -> (label, id prefix, outlet table, key, id); the catalog is grouped by page
OUTLETS = {"store": ("store channel", "store", "store", "s_store_sk", "s_store_id"),
           "catalog": ("catalog channel", "catalog_page", "catalog_page", "cp_catalog_page_sk",
                       "cp_catalog_page_id"),
           "web": ("web channel", "web_site", "web_site", "web_site_sk", "web_site_id")}


def channel_totals(lines: DataFrame) -> DataFrame:
    out = lines.rollup("channel", "id").agg(
        total("sales").alias("sales"), total("returns").alias("returns"), total("profit").alias("profit"))
    return leading(out, "channel", "id")


def money_row(channel: str, outlet, date, sales_=None, profit=None, returns_=None, loss=None) -> list[Column]:
    zero = F.lit(0.0)
    named = {"sales": sales_, "profit": profit, "returns": returns_, "loss": loss}
    return [F.lit(channel).alias("ch"), col(outlet).alias("outlet"), col(date).alias("date_sk"),
            *[(zero if c is None else col(c)).alias(n) for n, c in named.items()]]


@report
def q5(t: Star, start: str = "1998-08-04", length: int = 14) -> DataFrame:
    sold = t.web_sales.select(
        col("ws_item_sk").alias("k_item"), col("ws_order_number").alias("k_order"), "ws_web_site_sk")
    span = day_span(t, start, length).select(col("d_date_sk").alias("back_day"))
    web_back = match(match(t.web_returns, span, "left_semi", wr_returned_date_sk="back_day"), sold, "left",
                     wr_item_sk="k_item", wr_order_number="k_order")
    lines = union_all(
        t.store_sales.select(money_row("store", "ss_store_sk", "ss_sold_date_sk", "ss_ext_sales_price", "ss_net_profit")),
        t.store_returns.select(money_row("store", "sr_store_sk", "sr_returned_date_sk", None, None,
                                         "sr_return_amt", "sr_net_loss")),
        t.catalog_sales.select(money_row("catalog", "cs_catalog_page_sk", "cs_sold_date_sk", "cs_ext_sales_price",
                                         "cs_net_profit")),
        t.catalog_returns.select(money_row("catalog", "cr_catalog_page_sk", "cr_returned_date_sk", None, None,
                                           "cr_return_amount", "cr_net_loss")),
        t.web_sales.select(money_row("web", "ws_web_site_sk", "ws_sold_date_sk", "ws_ext_sales_price", "ws_net_profit")),
        web_back.select(money_row("web", "ws_web_site_sk", "wr_returned_date_sk", None, None, "wr_return_amt",
                                  "wr_net_loss")))
    lines = match(lines, day_span(t, start, length), date_sk="d_date_sk")
    return channel_totals(named_outlets(t, lines.withColumn("profit", col("profit") - col("loss"))))


def named_outlets(t: Star, lines: DataFrame) -> DataFrame:
    """Replace the outlet key of each channel by its labelled business id."""
    names = union_all(*[
        t.table(table).select(F.lit(ch).alias("n_ch"), col(key).alias("n_key"), F.lit(label).alias("channel"),
                              F.concat(F.lit(prefix), col(ident).cast("string")).alias("id"))
        for ch, (label, prefix, table, key, ident) in OUTLETS.items()])
    return match(lines, names, ch="n_ch", outlet="n_key")


@report
def q80(t: Star, start: str = "1998-08-04", price: float = 50) -> DataFrame:
    parts = []
    for ch, outlet, fact in (("store", "ss_store_sk", t.store_sales), ("catalog", "cs_catalog_page_sk", t.catalog_sales),
                             ("web", "ws_web_site_sk", t.web_sales)):
        p = outlet[:3]
        order = p + ("ticket_number" if ch == "store" else "order_number")
        parts.append(fact.select(
            F.lit(ch).alias("ch"), col(outlet).alias("outlet"), col(p + "sold_date_sk").alias("date_sk"),
            col(p + "item_sk").alias("item_sk"), col(p + "promo_sk").alias("promo_sk"), col(order).alias("order_no"),
            col(p + "ext_sales_price").alias("sales"), col(p + "net_profit").alias("net")))
    s = match(union_all(*parts), day_span(t, start, 30), date_sk="d_date_sk")
    s = match(s, t.item.where(col("i_current_price") > price).select("i_item_sk"), item_sk="i_item_sk")
    s = match(s, t.promotion.where("p_channel_tv = 'N'").select("p_promo_sk"), promo_sk="p_promo_sk")
    back = union_all(*[returns(t, c) for c in CHANNELS])
    s = match(s, back, "left", ch="r_channel", item_sk="r_item_sk", order_no="r_order_no")
    zero = F.lit(0.0)
    s = s.select("ch", "outlet", "sales", F.coalesce("return_amt", zero).alias("returns"),
                 (col("net") - F.coalesce("net_loss", zero)).alias("profit"))
    return channel_totals(named_outlets(t, s))


@report
def q77(t: Star, start: str = "1998-08-04") -> DataFrame:
    """Profit and loss per outlet; catalog returns are charged to every call centre.

    The catalog branch pairs each call centre with every returning call centre.
    Only the totals of that pairing are reported, so the returns are reduced to
    one row and each sales row is counted once per returning call centre.
    """
    span = day_span(t, start, 30).select("d_date_sk")

    def sold(fact, p, outlet):
        return match(t.table(fact), span, **{p + "sold_date_sk": "d_date_sk"}).groupBy(
            col(outlet).alias("id")).agg(total(p + "ext_sales_price").alias("sales"), total(p + "net_profit").alias("net"))

    def back(fact, p, outlet, amount):
        return match(t.table(fact), span, **{p + "returned_date_sk": "d_date_sk"}).groupBy(
            col(outlet).alias("rid")).agg(total(amount).alias("returns"), total(p + "net_loss").alias("loss"))

    zero = F.lit(0.0)
    parts = []
    for label, s, r in (("store channel", sold("store_sales", "ss_", "ss_store_sk"),
                         back("store_returns", "sr_", "sr_store_sk", "sr_return_amt")),
                        ("web channel", sold("web_sales", "ws_", "ws_web_page_sk"),
                         back("web_returns", "wr_", "wr_web_page_sk", "wr_return_amt"))):
        outlets = t.store.select(col("s_store_sk").alias("known")) if label[0] == "s" else t.web_page.select(
            col("wp_web_page_sk").alias("known"))
        s = match(match(s, outlets, "left_semi", id="known"), r, "left", id="rid")
        parts.append(s.select(F.lit(label).alias("channel"), "id", "sales",
                              F.coalesce("returns", zero).alias("returns"),
                              (col("net") - F.coalesce("loss", zero)).alias("profit")))
    r = back("catalog_returns", "cr_", "cr_call_center_sk", "cr_return_amount").agg(
        F.count("*").alias("centres"), total("returns").alias("returns"), total("loss").alias("loss"))
    s = sold("catalog_sales", "cs_", "cs_call_center_sk")
    centres, amount, loss = (r.select(c).scalar() for c in ("centres", "returns", "loss"))
    parts.insert(1, s.where(centres > 0).select(
        F.lit("catalog channel").alias("channel"), "id", (col("sales") * centres).alias("sales"),
        amount.alias("returns"), (col("net") * centres - loss).alias("profit")))
    return channel_totals(union_all(*parts))


SET = ("i_brand_id", "i_class_id", "i_category_id")


def channel_profile(t: Star, year: int) -> DataFrame:
    """Per brand, class and category: the channels that sold it in three years, and its worth.

    One pass over all channels; both the item sets and the mean sale come from it.
    """
    s = match(all_sales(t), days(t, f"d_year between {year} and {year + 2}"), sold_date_sk="d_date_sk")
    s = match(s, t.item.select("i_item_sk", *SET), "left", item_sk="i_item_sk")
    return materialized(s.groupBy(*[col(k).alias("x_" + k) for k in SET]).agg(
        *[F.max(col("channel") == c).alias(c) for c in CHANNELS],
        total(col("quantity") * col("list_price")).alias("worth"), F.count("*").alias("lines")))


def cross_item_sales(t: Star, s: DataFrame, year: int, *extra) -> DataFrame:
    """Sales of the item sets found in every channel that exceed the mean sale."""
    profile = channel_profile(t, year)
    typical = profile.agg((total("worth") / F.sum("lines")).alias("m"))
    everywhere = profile.where("store and catalog and web")
    items = match(t.item, everywhere, "left_semi", **{k: "x_" + k for k in SET})
    sums = match(s, items, item_sk="i_item_sk").groupBy("channel", *SET, *extra).agg(
        total(col("quantity") * col("list_price")).alias("sales"), F.count("*").alias("number_sales"))
    return sums.where(col("sales") > typical.scalar())


@report
def q14(t: Star, year: int = 1998, month: int = 11) -> DataFrame:
    s = match(all_sales(t), days(t, f"d_year = {year + 2} and d_moy = {month}"), sold_date_sk="d_date_sk")
    sums = cross_item_sales(t, s, year)
    keys = ["channel", "i_brand_id", "i_class_id", "i_category_id"]
    out = sums.rollup(*keys).agg(total("sales").alias("sum_sales"), F.sum("number_sales").alias("sum_number_sales"))
    return leading(out, *keys)


@report
def q14b(t: Star, year: int = 1998, month: int = 12, dom: int = 16) -> DataFrame:
    def week(y: int) -> DataFrame:
        return t.date_dim.where(f"d_year = {y} and d_moy = {month} and d_dom = {dom}").select("d_week_seq")

    this_week = col("d_week_seq") == week(year + 1).scalar()
    dates = t.date_dim.where(this_week | (col("d_week_seq") == week(year).scalar()))
    s = match(sales(t, "store"), dates.withColumn("is_now", this_week), sold_date_sk="d_date_sk")
    sums = cross_item_sales(t, s, year, "is_now")
    cols = ["channel", "i_brand_id", "i_class_id", "i_category_id", "sales", "number_sales"]
    now = sums.where("is_now").select(*cols)
    then = sums.where("not is_now").select(*[col(c).alias(c + "2") for c in cols])
    keys = {k: k + "2" for k in cols[1:4]}
    return leading(match(now, then, **keys), *cols[:4])


@report
def q18(t: Star, gender="M", education="College", months=(9, 5, 12, 4, 1, 10), year=2001,
        states=("ND", "WI", "AL", "NC", "OK", "MS", "TN")) -> DataFrame:
    people = t.customer_demographics.where((col("cd_gender") == gender) & (col("cd_education_status") == education))
    s = match(t.catalog_sales, days(t, f"d_year = {year}"), cs_sold_date_sk="d_date_sk")
    s = match(s, people, cs_bill_cdemo_sk="cd_demo_sk")
    buyers = match(t.customer.where(col("c_birth_month").isin(list(months))),
                   t.customer_demographics.select(col("cd_demo_sk").alias("own_demo")), "left_semi",
                   c_current_cdemo_sk="own_demo")
    s = match(s, buyers, cs_bill_customer_sk="c_customer_sk")
    s = match(s, t.customer_address.where(col("ca_state").isin(list(states))), c_current_addr_sk="ca_address_sk")
    s = match(s, t.item, cs_item_sk="i_item_sk")
    out = s.rollup("i_item_id", "ca_country", "ca_state", "ca_county").agg(
        F.avg("cs_quantity").alias("agg1"), mean("cs_list_price").alias("agg2"), mean("cs_coupon_amt").alias("agg3"),
        mean("cs_sales_price").alias("agg4"), mean("cs_net_profit").alias("agg5"),
        F.avg("c_birth_year").alias("agg6"), F.avg("cd_dep_count").alias("agg7"))
    return leading(out, "ca_country", "ca_state", "ca_county", "i_item_id")


@report
def q22(t: Star, month: int = 1212) -> DataFrame:
    s = stock_on(t, days(t, f"d_month_seq between {month} and {month + 11}"))
    s = match(s, t.item, inv_item_sk="i_item_sk")
    keys = ["i_product_name", "i_brand", "i_class", "i_category"]
    return leading(s.rollup(*keys).agg(F.avg("inv_quantity_on_hand").alias("qoh")), "qoh", *keys)


@report
def q27(t: Star, gender="M", marital="W", education="College", year=2002,
        states=("MO", "LA", "GA", "MI", "SC", "OH"), flag: bool = False) -> DataFrame:
    """``g_state`` repeats the state; with ``flag`` it tells subtotal rows apart."""
    people = t.customer_demographics.where((col("cd_gender") == gender) & (col("cd_marital_status") == marital)
                                           & (col("cd_education_status") == education))
    s = match(t.store_sales, people, ss_cdemo_sk="cd_demo_sk")
    s = match(s, days(t, f"d_year = {year}"), ss_sold_date_sk="d_date_sk")
    s = match(s, t.store.where(col("s_state").isin(list(states))), ss_store_sk="s_store_sk")
    s = match(s, t.item, ss_item_sk="i_item_sk")
    out = s.rollup("i_item_id", "s_state").agg(
        F.grouping("s_state").cast("int").alias("level"), F.avg("ss_quantity").alias("agg1"),
        mean("ss_list_price").alias("agg2"), mean("ss_coupon_amt").alias("agg3"), mean("ss_sales_price").alias("agg4"))
    out = out.select("i_item_id", "s_state", col("level" if flag else "s_state").alias("g_state"),
                     "agg1", "agg2", "agg3", "agg4")
    return leading(out, "i_item_id", "s_state")


def hierarchy(s: DataFrame, parent: str, child: str, value: Column, name: str, ascending: bool,
              exact: bool) -> DataFrame:
    """Subtotals over parent and child, ranked among rows of the same parent.

    Levels are told apart by null keys, so a real null key counts as a
    subtotal; ``exact`` uses the grouping flags instead.
    """
    out = s.rollup(parent, child).agg(value.alias(name), F.grouping(parent).alias("gp"), F.grouping(child).alias("gc"))
    if exact:
        level, has_child = col("gp") + col("gc"), col("gc") == 0
    else:
        level = col(parent).isNull().cast("int") + col(child).isNull().cast("int")
        has_child = col(child).isNotNull()
    out = out.withColumn("lochierarchy", level.cast("int")).withColumn("_within", F.when(has_child, col(parent)))
    # one row per hierarchy member, already aggregated
    by = W.partitionBy("lochierarchy", "_within").orderBy(col(name).asc_nulls_first() if ascending else col(name).desc_nulls_last())
    out = out.withColumn("rank_within_parent", F.rank().over(by).cast("bigint"))
    cols = [name, parent, child, "lochierarchy", "rank_within_parent"]
    top = F.when(col("lochierarchy") == 0, col(parent)).asc_nulls_first()
    return out.orderBy(*ordering("-lochierarchy"), top, *ordering("rank_within_parent", *cols)).limit(100).select(*cols)


@report
def q36(t: Star, year: int = 2000, states=("MO", "LA", "GA", "MI", "SC", "OH", "SD", "AL"),
        exact: bool = False) -> DataFrame:
    s = match(t.store_sales, days(t, f"d_year = {year}"), ss_sold_date_sk="d_date_sk")
    s = match(s, t.item, ss_item_sk="i_item_sk")
    s = match(s, t.store.where(col("s_state").isin(list(states))), ss_store_sk="s_store_sk")
    margin = total("ss_net_profit") / total("ss_ext_sales_price")
    return hierarchy(s, "i_category", "i_class", margin, "gross_margin", True, exact)


@report
def q86(t: Star, month: int = 1212, exact: bool = False) -> DataFrame:
    s = match(t.web_sales, days(t, f"d_month_seq between {month} and {month + 11}"), ws_sold_date_sk="d_date_sk")
    s = match(s, t.item, ws_item_sk="i_item_sk")
    return hierarchy(s, "i_category", "i_class", total("ws_net_paid"), "total_sum", False, exact)


@report
def q70(t: Star, month: int = 1212, exact: bool = False, best: int | None = None) -> DataFrame:
    """All states with sales; ``best`` keeps those whose profit ranks among the first."""
    s = match(t.store_sales, days(t, f"d_month_seq between {month} and {month + 11}"), ss_sold_date_sk="d_date_sk")
    s = match(s, t.store.where("s_state is not null"), ss_store_sk="s_store_sk")
    if best is not None:
        states = s.groupBy(col("s_state").alias("best_state")).agg(total("ss_net_profit").alias("state_profit"))
        states = with_rank(states, "state_profit", "ranking", descending=True).where(col("ranking") <= best)
        s = match(s, states, "left_semi", s_state="best_state")
    return hierarchy(s, "s_state", "s_county", total("ss_net_profit"), "total_sum", False, exact)


@report
def q67(t: Star, month: int = 1212) -> DataFrame:
    s = match(t.store_sales, days(t, f"d_month_seq between {month} and {month + 11}"), ss_sold_date_sk="d_date_sk")
    s = match(match(s, t.store, ss_store_sk="s_store_sk"), t.item, ss_item_sk="i_item_sk")
    keys = ["i_category", "i_class", "i_brand", "i_product_name", "d_year", "d_qoy", "d_moy", "s_store_id"]
    worth = F.coalesce(col("ss_sales_price") * col("ss_quantity"), F.lit(0.0))
    sums = s.rollup(*keys).agg(total(worth).alias("sumsales"))
    # Spark prunes each task to the leading ranks before the shuffle by category
    rk = F.rank().over(W.partitionBy("i_category").orderBy(col("sumsales").desc_nulls_last()))
    out = sums.withColumn("rk", rk).where("rk <= 100").withColumn("rk", col("rk").cast("bigint"))
    return leading(out, *keys, "sumsales", "rk")
