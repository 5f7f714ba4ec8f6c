"""Unbounded source of numbered rows, with offsets and replay.

``spark.dataSource.register(Numbered)``, then ``readStream.format("numbered")``.
Options: ``first`` (0), ``rows`` of a batch (1000), ``parts`` that read it (4)
and ``last``, after which no number follows; without it the source never ends.
An offset is the next number.  A range of offsets gives the same rows whenever
it is read, so a batch that is repeated after a failure is the same batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

SCHEMA = "num bigint, text string"
#: rows of one Arrow batch
BATCH = 10_000


class Span(InputPartition):
    """Numbers from ``first`` to before ``end``."""

    def __init__(self, first: int, end: int):
        self.first, self.end = first, end


class NumberedReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.first = int(options.get("first", 0))
        self.rows = int(options.get("rows", 1000))
        self.parts = int(options.get("parts", 4))
        self.last = int(options["last"]) if "last" in options else None
        self.seen: int | None = None

    def initialOffset(self) -> dict:
        return {"next": self.first}

    def latestOffset(self) -> dict:
        at = (self.first if self.seen is None else self.seen) + self.rows
        if self.last is not None:
            at = min(at, self.last + 1)
        self.seen = max(at, self.first)
        return {"next": self.seen}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        # a reader that is started again learns here how far the stream had come
        lo, hi = start["next"], end["next"]
        self.seen = hi if self.seen is None else max(self.seen, hi)
        size = -(-(hi - lo) // self.parts) or 1
        return [Span(i, min(i + size, hi)) for i in range(lo, hi, size)]

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        for lo in range(partition.first, partition.end, BATCH):
            numbers = range(lo, min(lo + BATCH, partition.end))
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array([f"string_value_{i}" for i in numbers], pa.string())], ["num", "text"])

    def commit(self, end: dict) -> None:
        pass


class Numbered(DataSource):
    """Rows ``(i, 'string_value_i')`` without end."""

    @classmethod
    def name(cls) -> str:
        return "numbered"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> NumberedReader:
        return NumberedReader(self.options)


def numbered_stream(spark: SparkSession, **options: int):
    """The numbered rows as a stream."""
    spark.dataSource.register(Numbered)
    return spark.readStream.format("numbered").options(**{k: str(v) for k, v in options.items()}).load()
