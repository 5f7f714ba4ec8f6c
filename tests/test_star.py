"""Reports on a small stored star and plan checks on the derived one."""

import tempfile

import pytest

from millrace.operators.relational import match
from millrace.plans.star import REPORTS, Star
from millrace.plans.star.tables import TABLES
from millrace.sinks.writes import save_star
from millrace.sources.files import register_tables

# these run a job while they are built
EAGER = {"q1", "q2", "q12", "q14", "q14b", "q20", "q23", "q23b", "q24", "q24b", "q30", "q32", "q39", "q39b", "q44", "q49",
         "q53", "q59", "q6", "q63", "q64", "q65", "q78", "q81", "q89", "q92", "q98"}
DAYS = [(1, "1998-05-01", 1998), (2, "1998-05-02", 1998)]


def star_of(spark, frames):
    return Star(spark, lambda name: frames[name])


def lines(spark, p, rows, who="", order="order_number", outlet="call_center_sk"):
    """Sales of (order, item, customer, quantity, price) on day 1, other columns filled in."""
    cols = {"sold_date_sk": 1, "sold_time_sk": 1, "promo_sk": 1, f"{who}addr_sk": 1, outlet: 1}
    money = ["list_price", "sales_price", "wholesale_cost", "ext_sales_price", "ext_list_price", "ext_discount_amt",
             "ext_wholesale_cost", "net_paid", "net_profit"]
    names = [*cols, order, "item_sk", f"{who}customer_sk", "quantity", *money]
    data = [(*cols.values(), o, i, c, q, *[float(v)] * len(money)) for o, i, c, q, v in rows]
    kinds = ["bigint"] * (len(cols) + 4) + ["double"] * len(money)
    return spark.createDataFrame(data, ", ".join(f"{p}{n} {k}" for n, k in zip(names, kinds)))


def backs(spark, p, order, amount, rows):
    return spark.createDataFrame([(i, o, 1, 1, 1.0, 1.0) for o, i in rows],
                                 f"{p}item_sk bigint, {p}{order} bigint, {p}returned_date_sk bigint, {p}return_quantity bigint, "
                                 f"{p}{amount} double, {p}net_loss double")


@pytest.fixture
def kept_star(spark):
    """Customer 1 keeps item 7 from all channels and item 8 from store, web and returns it elsewhere."""
    days = spark.createDataFrame(DAYS, "d_date_sk bigint, d_date string, d_year bigint")
    return star_of(spark, {
        "date_dim": days,
        "store_sales": lines(spark, "ss_", [(1, 7, 1, 4, 2), (1, 8, 1, 1, 3), (2, 7, None, 5, 2)], "", "ticket_number", "store_sk"),
        "catalog_sales": lines(spark, "cs_", [(3, 7, 1, 2, 2), (4, 9, 1, 6, 1)], "bill_"),
        "web_sales": lines(spark, "ws_", [(5, 7, 1, 2, 2), (6, 8, 1, 1, 5)], "bill_", "order_number", "web_site_sk"),
        "store_returns": backs(spark, "sr_", "ticket_number", "return_amt", []),
        "catalog_returns": backs(spark, "cr_", "order_number", "return_amount", []),
        "web_returns": backs(spark, "wr_", "order_number", "return_amt", [(6, 8)])})


def test_kept_purchases_by_customer_or_by_item(kept_star):
    by_customer = REPORTS["q78"](kept_star, year=1998).collect()
    assert [(r["ss_item_sk"], r["store_qty"], r["other_chan_qty"], r["ratio"]) for r in by_customer] == [(7, 4, 4, 1.0), (7, 4, 8, 0.5)]
    by_item = REPORTS["q78"](kept_star, year=1998, by_item=True).collect()
    assert [(r["ss_item_sk"], r["other_chan_qty"], r["other_chan_sales_price"]) for r in by_item] == [(7, 4, 4.0)]


def test_stored_star_gives_the_same_report(spark, sf_dir):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    derived = Star.derived(spark, sf_dir)
    names = ("store_sales", "date_dim", "item")
    year = Star(spark, lambda n: derived.table(n).where("ss_sold_date_sk < 34800") if n == "store_sales" else derived.table(n))
    save_star(year, path, names)
    stored = register_tables(spark, path, names)
    sold = match(match(year.store_sales, year.date_dim, ss_sold_date_sk="d_date_sk"), year.item, ss_item_sk="i_item_sk")
    maker, month = sold.select("i_manufact_id", "d_moy").first()
    a, b = (REPORTS["q3"](s, manufact=maker, month=month).collect() for s in (year, stored))
    assert a == b and len(a) > 0
    assert "dynamicpruning" in plan(REPORTS["q3"](stored, manufact=maker, month=month))
    assert spark.sql("select count(*) from item").first()[0] == derived.item.count()


def test_the_star_is_complete(spark, sf_dir):
    star = Star.derived(spark, sf_dir)
    assert len(REPORTS) == 103
    assert all(star.table(name).columns for name in TABLES)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_cross_joins(spark, sf_dir):
    """Besides scalar subqueries no report pairs rows without a key."""
    star = Star.derived(spark, sf_dir)
    for name in sorted(set(REPORTS) - EAGER):
        text = plan(REPORTS[name](star))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_scans_read_only_what_a_report_needs(spark, sf_dir):
    text = plan(REPORTS["q3"](Star.derived(spark, sf_dir)))
    scans = [line for line in text.splitlines() if "ReadSchema" in line]
    assert any("l_partkey" in s and "l_returnflag" not in s for s in scans)


@pytest.mark.parametrize("name", ["q25", "q93"])
def test_stored_stars_hold_what_their_report_joins_by_order_and_item(spark, sf_dir, name):
    import __spark_entry__ as entry
    star = entry._STORED[name](spark, sf_dir)
    derived = entry._open(entry.Star.derived, spark, sf_dir)
    for table, columns in entry.BUCKETED[name].items():
        assert star.table(table).columns == list(columns) and star.table(table).count() == derived.table(table).count()
    assert star.item is derived.item and star.catalog_sales is derived.catalog_sales
