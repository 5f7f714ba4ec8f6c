"""Named reports over a retail star."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

REPORTS: dict[str, Callable[..., DataFrame]] = {}


def report(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    REPORTS[fn.__name__] = fn
    return fn
