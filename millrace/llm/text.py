"""Column expressions that several operators share."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import scratch

#: the blanks of the word rule ``[^\x20\x09-\x0D]+``
BLANKS = " \t\n\x0b\f\r"


def whole(text: Column) -> Column:
    """Null counts as the empty text."""
    return F.coalesce(text, F.lit(""))


def lowered(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def blank_words(text: Column) -> Column:
    """Words between blanks; an empty array where there is none."""
    return F.array_remove(F.split(text, r"[ \t-\r]+"), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, also where body uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def count_of(text: Column, chars: str) -> Column:
    """Code points of a text that are among ``chars``."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def covered(starts: Column, lengths: Callable[[Column], Column] | int, at: Callable[[Column], Column] = lambda x: x) -> Column:
    """Positions below intervals that are sorted by start."""
    size = (lambda x: F.lit(lengths)) if isinstance(lengths, int) else lengths
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum"))

    def step(acc, x):
        end = (at(x) + size(x)).cast("int")
        gain = F.greatest(end - F.greatest(at(x), acc["end"]), F.lit(0)).cast("int")
        return F.struct(F.greatest(acc["end"], end).alias("end"), (acc["sum"] + gain).alias("sum"))

    return F.aggregate(starts, zero, step, lambda acc: acc["sum"])


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    """Whether crc32 of the id as text leaves ``part`` by ``parts``; rows without id are held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == part, F.lit(True))


def read(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """Written to the shared folder as a table and read again; columns that are not used are not read."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark) -> None:
    """Bound what a Python worker gets at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def without(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """Documents whose id and text are not among the ``bad`` pairs (xxhash64 of id and text, id); all columns kept, whatever their names."""
    bad = bad.toDF("bad_key", "bad_id").distinct()
    rows = docs.select(F.xxhash64("doc_id", "text").alias("own_key"), F.struct("*").alias("d"))
    rows = rows.join(bad, (F.col("own_key") == F.col("bad_key")) & F.col("d.doc_id").eqNullSafe(F.col("bad_id")), "left_anti")
    return rows.select(*[F.col("d").getField(c).alias(c) for c in docs.columns])
