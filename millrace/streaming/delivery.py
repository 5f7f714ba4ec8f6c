"""Rows sent to a sink that may refuse them: retried, kept as dead letters, sent again.

A sink takes rows and the number of the attempt and answers every row with a
``reason``, null for a row that landed.  Passing reasons are tried again, at
most so many times in all; other rows, and those that run out of attempts,
become dead letters: messages with the reason, the attempts and the round as
attributes.  A second stream reads the dead letters as its messages, repairs
them and sends them again; what fails then is buried.

The answers of an attempt are a table of their own.  A batch that is run again
goes on after the last attempt whose answers are whole, so a row that has
landed is not sent again.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.relational import union_all
from millrace.sinks import folders

# reasons that pass, and SQL states of errors that do (fixed values)
PASSING = ("timeout", "unavailable", "throttled")
PASSING_STATES = ("08", "40", "53", "57", "58")

Sink = Callable[[DataFrame, int], DataFrame]
DEAD = "data binary, attributes map<string,string>, publish_time timestamp"


def passes(error: BaseException) -> bool:
    """Whether an error of a job may be gone the next time."""
    if isinstance(error, (ConnectionError, TimeoutError)):
        return True
    state = error.getSqlState() if isinstance(error, PySparkException) else None
    return bool(state) and state[:2] in PASSING_STATES


def retried(action: Callable[[], object], attempts: int = 5, wait: float = 1.0, passing: Callable[[BaseException], bool] = passes,
            sleep: Callable[[float], None] = time.sleep):
    """The result of an action; errors that pass are tried again after a wait that doubles, others are raised at once."""
    for attempt in range(1, attempts + 1):
        try:
            return action()
        except Exception as error:
            if attempt == attempts or not passing(error):
                raise
            sleep(wait * 2 ** (attempt - 1))


def _answer_schema(rows: DataFrame):
    return rows.withColumn("reason", F.lit(None).cast("string")).schema


def answered(rows: DataFrame, sink: Sink, path: str, attempts: int, wait: float = 1.0) -> DataFrame:
    """Rows with ``reason`` and ``attempt`` of their last attempt; ``path`` holds the answers of every attempt."""
    spark, pending, done = rows.sparkSession, rows, []
    for attempt in range(1, attempts + 1):
        at = f"{path}/attempt={attempt}"
        if not folders.exists(spark, f"{at}/_SUCCESS"):
            retried(lambda: sink(pending, attempt).write.mode("overwrite").parquet(at), wait=wait)
        answers = spark.read.schema(_answer_schema(rows)).parquet(at).withColumn("attempt", F.lit(attempt))
        again = F.col("reason").isin(*PASSING) if attempt < attempts else F.lit(False)
        done.append(answers.where(~F.coalesce(again, F.lit(False))))
        pending = answers.where(again).drop("reason", "attempt")
        if pending.isEmpty():
            break
    return union_all(*done)


def as_dead_letters(failed: DataFrame, round_: int) -> DataFrame:
    """Messages that carry why, after how many attempts and in which round they failed."""
    notes = F.create_map(F.lit("reason"), "reason", F.lit("attempts"), F.col("attempt").cast("string"), F.lit("round"), F.lit(str(round_)))
    own = F.map_filter(F.coalesce("attributes", F.create_map().cast("map<string,string>")), lambda k, _: ~k.isin("reason", "attempts", "round"))
    return failed.select("data", F.map_concat(own, notes).alias("attributes"), "publish_time")


def deliver_batch(batch: DataFrame, number: int, sink: Sink, out: str, attempts: int = 3, round_: int = 1, wait: float = 1.0,
                  valid: Column | None = None) -> None:
    """Landed rows under ``out/rows``, dead letters under ``out/dead_letters``; rows that are not ``valid`` are not sent."""
    good = F.coalesce(F.lit(True) if valid is None else valid, F.lit(False))
    checked = batch.persist()
    try:
        results = answered(checked.where(good), sink, f"{out}/answers/batch={number}", attempts, wait)
        refused = checked.where(~good).withColumns({"reason": F.lit("invalid"), "attempt": F.lit(0)})
        landed = results.where("reason is null").drop("reason")
        landed.write.mode("overwrite").parquet(f"{out}/rows/batch={number}")
        dead = as_dead_letters(union_all(results.where("reason is not null"), refused), round_)
        dead.write.mode("overwrite").parquet(f"{out}/dead_letters/batch={number}")
    finally:
        checked.unpersist()


def start_delivery(messages: DataFrame, sink: Sink, out: str, checkpoint: str, attempts: int = 3, wait: float = 1.0,
                   valid: Column | None = None) -> StreamingQuery:
    """Deliver a stream of ``data, attributes, publish_time`` messages."""
    return (messages.writeStream.foreachBatch(lambda df, i: deliver_batch(df, i, sink, out, attempts, 1, wait, valid))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def start_resending(spark, dead: str, repair: Callable[[DataFrame], DataFrame], sink: Sink, out: str, checkpoint: str,
                    attempts: int = 3, wait: float = 1.0, valid: Column | None = None) -> StreamingQuery:
    """Send dead letters again after a repair; what fails again stays under ``out/dead_letters``."""
    letters = spark.readStream.schema(DEAD).parquet(f"{dead}/batch=*")
    return (repair(letters).writeStream.foreachBatch(lambda df, i: deliver_batch(df, i, sink, out, attempts, 2, wait, valid))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
