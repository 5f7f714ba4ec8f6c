"""Turning rows into arrays of structs without unbounded groups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.relational import same

#: items of one array, about
MOST = 10_000


def nested(df: DataFrame, keys: list[str], item: Column, name: str, part: Column, most: int = MOST) -> DataFrame:
    """A row per key, ``part`` and ``piece`` with the items in a sorted array.

    ``part`` is a rule on the item, such as its calendar month.  Parts with more
    than ``most`` items are dealt by a hash of the item to as many pieces as
    they need, whatever the key; all others are piece 0.
    """
    rows = df.select(*keys, part.alias("part"), item.alias("_item"))
    names = [*keys, "part"]
    large = rows.groupBy(*[F.col(k).alias(f"_l_{k}") for k in names]).agg(F.count("*").alias("_n")).where(F.col("_n") > most)
    on = reduce(lambda a, b: a & b, [same(F.col(k), F.col(f"_l_{k}")) for k in names])
    pieces = F.ceil(F.col("_n") / most)
    dealt = rows.join(large, on, "left").withColumn("piece", F.coalesce(F.pmod(F.xxhash64("_item"), pieces), F.lit(0)).cast("int"))
    return dealt.groupBy(*names, "piece").agg(F.sort_array(F.collect_list("_item")).alias(name))
