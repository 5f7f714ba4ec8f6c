"""Tumbling windows: word counts and one row per user and window.

Event time is the publish time, a window is emitted once when the watermark
passes its end, and rows behind the watermark are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.text import words

DELAY = "0 seconds"


def windowed_words(lines: DataFrame, size: str = "15 seconds", delay: str = DELAY) -> DataFrame:
    """Words per window of a stream with ``line`` and ``publish_time``."""
    one = lines.withWatermark("publish_time", delay).select("publish_time", F.explode(words(F.col("line"))).alias("word"))
    return one.groupBy(F.window("publish_time", size).alias("w"), "word").agg(F.count("*").alias("count"))


def window_rows(counts: DataFrame, process_time: Column | None = None) -> DataFrame:
    """Sink rows; the row index is part of the layout but never filled."""
    now = F.current_timestamp() if process_time is None else process_time
    return counts.select("word", "count", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                         now.alias("process_time"), F.lit(None).cast("bigint").alias("row_index"))


# fields of an event payload (fixed values)
PAYLOAD = "user_id string, event_name string, region string"


def parsed(lines: DataFrame) -> DataFrame:
    """Payload fields of JSON lines; ``step_name`` marks lines that cannot be read."""
    body = F.from_json("line", PAYLOAD)
    broken = F.col("body").isNull() | F.coalesce("body.user_id", "body.event_name", "body.region").isNull()
    p = lines.withColumn("body", body)
    return p.select("*", "body.user_id", "body.event_name", F.when(broken, "extractElement").alias("step_name"))


def users_in_windows(events: DataFrame, size: str = "5 seconds", delay: str = DELAY) -> DataFrame:
    """One row per user and window however many events fall into it."""
    return (events.withWatermark("publish_time", delay)
            .groupBy(F.window("publish_time", size).alias("w"), "user_id").agg(F.count("*").alias("events_in_window")))


def deduplicated(messages: DataFrame, key: str, delay: str) -> DataFrame:
    """First message per key; keys are forgotten once the watermark has passed."""
    return messages.withWatermark("publish_time", delay).dropDuplicatesWithinWatermark([key])


def cogrouped(left: DataFrame, right: DataFrame, left_value: str, right_value: str) -> DataFrame:
    """Two windowed streams joined on window and user; both hold one row per pair.

    The window time carries the watermark, so join state is dropped with it.
    """
    a = left.select(F.window_time("w").alias("at"), F.col("user_id").alias("user_id"), F.col(left_value).alias("left_value"))
    b = right.select(F.window_time("w").alias("b_at"), F.col("user_id").alias("b_user"), F.col(right_value).alias("right_value"))
    both = a.join(b, (F.col("at") == F.col("b_at")) & (F.col("user_id") == F.col("b_user")))
    return both.select("at", "user_id", "left_value", "right_value")
