"""Sums and averages of amounts held as doubles with whole cents.

Adding doubles in a different order changes the last bits, and partitions are
merged in no fixed order.  Rounding the total back to the unit of the inputs
gives the same double on every run.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def total(c: Column | str, scale: int = 2) -> Column:
    return F.round(F.sum(_col(c)), scale)


def mean(c: Column | str, scale: int = 2) -> Column:
    """Average of cent amounts; null for an empty group."""
    n = F.count(_col(c))
    return F.when(n > 0, total(c, scale) / n)


def ratio(a: Column | str, b: Column | str) -> Column:
    """``a / b``, null unless ``b`` is positive."""
    a, b = _col(a), _col(b)
    return F.when(b > 0, a / b)


def half_up(c: Column, scale: int) -> Column:
    """Round halves up with plain double arithmetic."""
    unit = 10.0 ** scale
    return F.floor(c * unit + 0.5) / unit
