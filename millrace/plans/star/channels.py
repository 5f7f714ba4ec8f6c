"""The three sales channels under common column names."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from millrace.operators.relational import union_all
from millrace.plans.star.tables import Star

CHANNELS = ("store", "catalog", "web")

# channel -> (column prefix, buyer prefix, order column, outlet column)
_SALES = {"store": ("ss_", "", "ticket_number", "store_sk"),
          "catalog": ("cs_", "bill_", "order_number", "call_center_sk"),
          "web": ("ws_", "bill_", "order_number", "web_site_sk")}
_SHARED = ("sold_date_sk", "sold_time_sk", "item_sk", "promo_sk", "quantity", "list_price",
           "sales_price", "wholesale_cost", "ext_sales_price", "ext_list_price",
           "ext_discount_amt", "ext_wholesale_cost", "net_paid", "net_profit")
_RETURNS = {"store": ("sr_", "ticket_number", "return_amt"),
            "catalog": ("cr_", "order_number", "return_amount"),
            "web": ("wr_", "order_number", "return_amt")}


def sales(t: Star, channel: str) -> DataFrame:
    p, who, order, outlet = _SALES[channel]
    return t.table(f"{channel}_sales").select(
        F.lit(channel).alias("channel"), F.col(f"{p}{who}customer_sk").alias("customer_sk"),
        F.col(f"{p}{who}addr_sk").alias("addr_sk"), F.col(p + order).alias("order_no"),
        F.col(p + outlet).alias("outlet_sk"), *[F.col(p + c).alias(c) for c in _SHARED])


def returns(t: Star, channel: str) -> DataFrame:
    p, order, amount = _RETURNS[channel]
    return t.table(f"{channel}_returns").select(
        F.lit(channel).alias("r_channel"), F.col(p + "item_sk").alias("r_item_sk"),
        F.col(p + order).alias("r_order_no"), F.col(p + "returned_date_sk").alias("returned_date_sk"),
        F.col(p + "return_quantity").alias("return_quantity"), F.col(p + amount).alias("return_amt"),
        F.col(p + "net_loss").alias("net_loss"))


def all_sales(t: Star, *channels: str) -> DataFrame:
    return union_all(*[sales(t, c) for c in channels or CHANNELS])


def all_returns(t: Star, *channels: str) -> DataFrame:
    return union_all(*[returns(t, c) for c in channels or CHANNELS])
