"""Logout events joined with the country and history of their user.

Every side grows with the users, so none is sent to the driver and from there to all: the joins are merged.
A side that Spark measures as 10 MB, compressed, would be ten times as much in the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.nesting import nested
from millrace.operators.relational import match
from millrace.streaming.windows import DELAY, parsed, users_in_windows


def country_of(users: DataFrame, countries: DataFrame) -> DataFrame:
    """Country per user, null when unknown; of several rows the greatest name is taken."""
    one = countries.groupBy(F.col("user_id").alias("c_user")).agg(F.max("country").alias("country"))
    return match(users, one.hint("merge"), "left", user_id="c_user").drop("c_user")


def history_of(users: DataFrame, history: DataFrame) -> DataFrame:
    """Earlier events per user as an array of structs, null when there are none.

    Only the users at hand are looked up.  There is a row per user and month of
    history (``part``), so a long history is never one group.
    """
    own = users.select(F.col("user_id").alias("h_user")).distinct().hint("merge")
    mine = history.join(own, F.col("user_id") == F.col("h_user"), "left_semi")
    item = F.struct("event_date", "event_name", "device")
    lists = nested(mine, ["user_id"], item, "events", F.substring("event_date", 1, 7))
    lists = lists.withColumnRenamed("user_id", "h_user")
    return match(users, lists.hint("merge"), "left", user_id="h_user").drop("h_user")


def enriched(users: DataFrame, countries: DataFrame, history: DataFrame) -> DataFrame:
    """Result records: user, country and history of every (user, window)."""
    full = history_of(country_of(users, countries), history)
    return full.select("user_id", F.col("w.start").alias("window_start"), "country", "part", "events")


def write_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """Idempotent: a batch that is run again replaces its own folder."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def start_enrichment(lines: DataFrame, countries: DataFrame, history: DataFrame, event: str, out: str,
                     checkpoint: str, delay: str = DELAY) -> list[StreamingQuery]:
    """Results to ``out/result`` and unreadable messages to ``out/result_err``."""
    p = parsed(lines)
    users = users_in_windows(p.where((F.col("event_name") == event) & F.col("step_name").isNull()), delay=delay)

    def results(batch: DataFrame, batch_id: int) -> None:
        # the windows of the batch are joined three times but taken from the state once
        users = batch.persist()
        try:
            full = enriched(users, countries, history)
            write_batch(full.limit(0) if users.isEmpty() else full, batch_id, f"{out}/result")
        finally:
            users.unpersist()

    def errors(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.select("step_name", "user_id"), batch_id, f"{out}/result_err")

    return [
        users.writeStream.outputMode("append").foreachBatch(results)
        .option("checkpointLocation", f"{checkpoint}/result").trigger(availableNow=True).start(),
        p.where("step_name is not null").writeStream.foreachBatch(errors)
        .option("checkpointLocation", f"{checkpoint}/errors").trigger(availableNow=True).start(),
    ]
