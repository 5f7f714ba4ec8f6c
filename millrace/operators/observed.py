"""Counters that a job reports beside what it writes, from the same pass over its input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.text import blank, words

#: counters of a text job (fixed values); how the ones of several batches go together
WORD_METRICS = {"words": "sum", "word_lengths": "sum", "min_len": "min", "max_len": "max", "empty_lines": "sum"}
_TYPES = "words bigint, word_lengths bigint, min_len int, max_len int, empty_lines bigint"


def word_rows(lines: DataFrame) -> DataFrame:
    """The words of each ``line``, and what is counted of it."""
    found = words(F.trim("line"), apostrophes=True)
    return lines.select("line", found.alias("words"))


def word_metrics() -> list[Column]:
    """Words, their total, least and greatest length, and blank lines of :func:`word_rows`."""
    lengths = F.transform("words", lambda w: F.length(w))
    total = F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, x: a + x)
    return [F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("words"), F.coalesce(F.sum(total), F.lit(0)).alias("word_lengths"),
            F.min(F.array_min(lengths)).alias("min_len"), F.max(F.array_max(lengths)).alias("max_len"),
            F.count_if(blank(F.col("line"))).alias("empty_lines")]


def counted_words(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def write_observed(df: DataFrame, result, metrics: list[Column], path: str) -> dict:
    """Write ``result(df)`` and give the metrics of ``df`` that the write has seen on its way.

    Spark drops the observed part of a plan whose result turns out to be empty; then there is little, and it is counted anew.
    """
    seen = Observation()
    result(df.observe(seen, *metrics)).write.mode("overwrite").parquet(path)
    if df.sparkSession.read.parquet(path).isEmpty():
        return df.agg(*metrics).first().asDict()
    return seen.get


def start_observed(lines: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Word counts of a stream by batch below ``out/counts``, and the counters of each batch below ``out/metrics``.

    A batch that is run again replaces both.
    """
    def write(df: DataFrame, batch: int) -> None:
        seen = write_observed(word_rows(df), counted_words, word_metrics(), f"{out}/counts/batch={batch}")
        row = df.sparkSession.createDataFrame([tuple(seen[m] for m in WORD_METRICS)], _TYPES)
        row.write.mode("overwrite").parquet(f"{out}/metrics/batch={batch}")

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def summed(metrics: DataFrame) -> DataFrame:
    """One row for the counters of any number of batches, with the mean length."""
    one = metrics.agg(*[getattr(F, how)(name).alias(name) for name, how in WORD_METRICS.items()])
    return one.withColumn("mean_len", F.col("word_lengths") / F.col("words"))
