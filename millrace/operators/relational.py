"""Joins, ordering and group totals used by the reports.

No join is hinted: Spark broadcasts a side only when its known or measured size
is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both
sides, splitting skewed partitions at run time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def match(left: DataFrame, right: DataFrame, how: str = "inner", **keys: str) -> DataFrame:
    """Equi-join where each keyword names a left column and its value a right column."""
    return left.join(right, [F.col(a) == F.col(b) for a, b in keys.items()], how)


def renamed(df: DataFrame, old: str, new: str) -> DataFrame:
    """Give a dimension another role by swapping the prefix of its columns."""
    return df.toDF(*[new + c[len(old):] if c.startswith(old) else c for c in df.columns])


def ordering(*names: str) -> list[Column]:
    """``"a"`` ascending with nulls first, ``"-a"`` descending with nulls last."""
    return [F.col(n[1:]).desc_nulls_last() if n[0] == "-" else F.col(n).asc_nulls_first()
            for n in names]


def leading(df: DataFrame, *order: str, n: int = 100) -> DataFrame:
    """First ``n`` rows; all columns break ties, so the cut is repeatable."""
    return df.orderBy(*ordering(*order), *ordering(*df.columns)).limit(n)


def sorted_rows(df: DataFrame, *order: str) -> DataFrame:
    return df.orderBy(*ordering(*order), *ordering(*df.columns))


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def with_group(df: DataFrame, keys: list[str], *aggs: Column) -> DataFrame:
    """Attach per-group aggregates to every row of the group.

    Equivalent to an aggregate over an unordered window, but the group is
    reduced map-side before it is shuffled and the rows of a large group stay
    spread over many tasks.  Null keys form a group of their own.
    """
    totals = df.groupBy(*[F.col(k).alias(f"_g_{k}") for k in keys]).agg(*aggs)
    on = reduce(lambda a, b: a & b, [same(F.col(k), F.col(f"_g_{k}")) for k in keys])
    return df.join(totals, on).drop(*[f"_g_{k}" for k in keys])


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
