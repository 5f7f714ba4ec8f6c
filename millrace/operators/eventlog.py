"""Folding add and delete events into the multiset they leave behind.

The count of one value goes up on ``add`` and down on ``delete`` but never
below zero.  For a run of events that is a pair (sum, lowest running sum), and
pairs of neighbouring runs combine, so a hot value is folded in slices of time
instead of one long run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from millrace.operators.ranking import count_percentiles
from millrace.session import shuffle_parts


def surviving(events: DataFrame, keys: list[str], value: str, at: str, step: str, slices: int | None = None) -> DataFrame:
    """Keys, value and ``n`` copies left; ``step`` is +1 or -1, ``at`` a unique integer order.

    By default there are as many slices as a shuffle has parts.
    """
    slices = slices or shuffle_parts(events.sparkSession)
    span = events.agg(F.min(at).alias("lo"), F.max(at).alias("hi"))
    width = F.greatest(F.ceil((span.select("hi").scalar() - span.select("lo").scalar() + 1) / slices), F.lit(1))
    sliced = events.withColumn("_slice", F.floor((F.col(at) - span.select("lo").scalar()) / width))
    group = keys + [value]
    run = W.partitionBy(*group, "_slice").orderBy(at).rowsBetween(W.unboundedPreceding, 0)
    parts = (sliced.withColumn("_sum", F.sum(step).over(run))
             .groupBy(*group, "_slice").agg(F.sum(step).alias("_total"), F.min("_sum").alias("_low")))
    # at most `slices` rows per value from here on
    before = W.partitionBy(*group).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("_base", F.coalesce(F.sum("_total").over(before), F.lit(0)))
    out = parts.groupBy(*group).agg(F.sum("_total").alias("_end"), F.min(F.col("_base") + F.col("_low")).alias("_lowest"))
    n = F.col("_end") - F.least(F.col("_lowest"), F.lit(0))
    return out.select(*group, n.alias("n")).where("n > 0")


def lower_median(counted: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Left-middle value of each counted multiset; an empty one has no row."""
    return count_percentiles(counted, value, [0.5], keys, interpolate=False).select(*keys, F.col("value").alias("median"))
