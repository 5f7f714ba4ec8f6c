"""Positions in a total order without moving everything into one task.

Rows are first reduced to distinct values with counts, so ties of any size cost
one row.  The values are split into ranges by cut points; each range is counted
on its own and shifted by the size of the ranges before it.
"""

from __future__ import annotations

import decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from millrace.operators.relational import same
from millrace.session import materialized, shuffle_parts


def cut_points(df: DataFrame, value: str, ranges: int) -> list:
    """At most ``ranges - 1`` approximate quantiles; balance only, never the result."""
    shares = [i / ranges for i in range(1, ranges)]
    row = df.agg(F.percentile_approx(value, shares, 10 * ranges).alias("cuts")).first()
    return sorted(set(row["cuts"] or []))


def slot_of(value: Column, cuts: list) -> Column:
    """Number of cut points below a value, by halving one array of them."""
    if not cuts:
        return F.lit(0)
    kinds = {type(c) for c in cuts}
    if kinds <= {int, float, decimal.Decimal}:
        # one literal, however many cut points
        kind = "double" if float in kinds else "decimal(38,18)" if decimal.Decimal in kinds else "bigint"
        points = F.split(F.lit(",".join(map(str, cuts))), ",").cast(f"array<{kind}>")
    else:
        points = F.array(*map(F.lit, cuts))
    steps = [1 << i for i in range(len(cuts).bit_length() - 1, -1, -1)]

    def step(acc: Column, s: Column) -> Column:
        below = (acc + s <= len(cuts)) & (F.try_element_at(points, acc + s) < value)
        return acc + F.when(below, s).otherwise(0)

    return F.when(value.isNotNull(), F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step))


def value_counts(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))


def ranged(counts: DataFrame, value: str, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Counts with the range (``_slot``) of their value, and per key and range its ``_size``, the rows before it and of the key.

    There are as many ranges as a shuffle has parts.
    """
    ranges = shuffle_parts(counts.sparkSession)
    counts = materialized(counts)
    counts = counts.withColumn("_slot", slot_of(F.col(value), cut_points(counts, value, ranges)))
    sizes = counts.groupBy(*keys, "_slot").agg(F.sum("n").alias("_size"))
    if keys:
        # at most `ranges` rows per key reach these windows
        own = W.partitionBy(*keys)
        earlier = own.orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
        return counts, sizes.withColumns({"_base": F.coalesce(F.sum("_size").over(earlier), F.lit(0)), "_total": F.sum("_size").over(own)})
    # one row per range
    rows, base, total = sorted(sizes.collect()), 0, 0
    out = []
    for slot, size in rows:
        out.append((slot, size, base))
        base += size
    total = base
    return counts, counts.sparkSession.createDataFrame([(*r, total) for r in out], "_slot int, _size bigint, _base bigint, _total bigint")


def _placed(counts: DataFrame, sizes: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Counts of the given ranges with ``before``, the rows of the key below the value."""
    renamed = sizes.withColumnsRenamed({c: "_b_" + c for c in keys + ["_slot"]})
    on = reduce(lambda a, b: a & b, [same(F.col(c), F.col("_b_" + c)) for c in keys + ["_slot"]])
    inside = W.partitionBy(*keys, "_slot").orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    placed = counts.join(renamed, on).withColumn("_inner", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return placed.withColumn("before", F.col("_base") + F.col("_inner"))


def value_offsets(df: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """Per key and distinct non-null value: ``n`` rows with it and ``before`` rows below it."""
    keys = keys or []
    counts, sizes = ranged(value_counts(df, value, keys), value, keys)
    return _placed(counts, sizes, value, keys).select(*keys, value, "n", "before")


def with_rank(df: DataFrame, value: str, name: str, keys: list[str] | None = None,
              descending: bool = False) -> DataFrame:
    """``rank()`` of non-null values over the whole table or per key."""
    keys = keys or []
    work = df.withColumn("_v", -F.col(value) if descending else F.col(value))
    places = value_offsets(work, "_v", keys).select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], F.col("_v").alias("_r_v"),
        (F.col("before") + 1).alias(name))
    on: Column = F.col("_v") == F.col("_r_v")
    for k in keys:
        on = on & same(F.col(k), F.col(f"_r_{k}"))
    return work.join(places, on).drop("_v", "_r_v", *[f"_r_{k}" for k in keys])


def first_ranks(df: DataFrame, value: str, name: str, k: int, descending: bool = False) -> DataFrame:
    """Rows whose ``rank()`` is at most ``k``; needs only the ``k`` leading values."""
    leading = (df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("_lead")).agg(F.count("*").alias("_n"))
               .orderBy(F.col("_lead").desc() if descending else F.col("_lead")).limit(k))
    ranks, before = [], 0
    for r in leading.collect():  # at most k rows
        if before < k:
            ranks.append((r["_lead"], before + 1))
        before += r["_n"]
    kind = leading.schema["_lead"].dataType.simpleString()
    lead = df.sparkSession.createDataFrame(ranks, f"_lead {kind}, {name} bigint")
    return df.join(lead, F.col(value) == F.col("_lead")).drop("_lead")


def percentiles(df: DataFrame, value: str, shares: list[float], keys: list[str] | None = None,
                interpolate: bool = True) -> DataFrame:
    """Exact percentiles; linear between neighbours, or the lower neighbour."""
    keys = keys or []
    return count_percentiles(value_counts(df, value, keys), value, shares, keys, interpolate)


def count_percentiles(counts: DataFrame, value: str, shares: list[float], keys: list[str],
                      interpolate: bool = True) -> DataFrame:
    """Percentiles of distinct values with ``n`` copies; only the ranges that hold a wanted position are sorted."""
    counts, sizes = ranged(counts, value, keys)
    targets = []
    for s in shares:
        position = F.lit(float(s)) * (F.col("_total") - 1)
        part = position - F.floor(position) if interpolate else F.lit(0.0)
        ends = [F.floor(position)] + ([F.ceil(position)] if interpolate else [])
        targets += [F.struct(F.lit(float(s)).alias("share"), part.alias("part"), e.alias("at")) for e in ends]

    def within(low, size):
        return lambda x: (low <= x["at"]) & (x["at"] < low + size)

    sizes = sizes.withColumn("_wanted", F.filter(F.array(*targets), within(F.col("_base"), F.col("_size")))).where(F.size("_wanted") > 0)
    placed = _placed(counts, sizes, value, keys)
    found = placed.withColumn("hit", F.explode(F.filter("_wanted", within(F.col("before"), F.col("n")))))
    out = found.groupBy(*keys, F.col("hit.share").alias("share")).agg(
        F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.max("hit.part").alias("_part"))
    return out.select(*keys, "share", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_part")).alias("value"))
