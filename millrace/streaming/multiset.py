"""Multisets kept up to date by a stream of add and delete events.

The count of a value goes up on ``add`` and down on ``delete``, never below zero.
Counts are state: one map of value to count per key and slot, where a slot is a
range of values, so a hot key is many groups and a map has at most as many
entries as a slot has values.  After every batch the slots it touched are
written once, a small table keeps the size of every slot and the batch that
wrote it last, and the lower median reads only the slots that hold it.
Everything a batch writes goes to folders of its number, so a batch that is
run again replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from millrace.sinks import folders

#: values of one slot
WIDTH = 1000
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TOUCHED = "key string, slot bigint, size bigint, counts array<struct<value:bigint,n:bigint>>"
SLOTS = "key string, slot bigint, size bigint, written bigint"
MEDIANS = "key string, size bigint, median bigint"


class Counts(StatefulProcessor):
    """Counts of the values of one key and slot; gives all of them after a batch that touched the slot."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("counts", "value bigint", "n bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # the events of one slot in one batch, in order; those of a value are its sum and its lowest running sum
        events = pd.concat([r[["value", "at", "step"]] for r in rows]).sort_values("at", kind="stable")
        running = events.groupby("value", dropna=False)["step"].cumsum()
        folded = events.assign(running=running).groupby("value", dropna=False).agg(total=("step", "sum"), low=("running", "min"))
        for value, total, low in folded.itertuples(name=None):
            value = None if pd.isna(value) else int(value)
            found = self.counts.containsKey((value,))
            n = self.counts.getValue((value,))[0] if found else 0
            n += int(total) - min(n + int(low), 0)
            if n:
                self.counts.updateValue((value,), (n,))
            elif found:
                self.counts.removeKey((value,))
        held = sorted((k[0], v[0]) for k, v in self.counts.iterator())
        yield pd.DataFrame({"key": [key[0]], "slot": [key[1]], "size": [sum(n for _, n in held)], "counts": [[{"value": v, "n": n} for v, n in held]]})


def touched(events: DataFrame, width: int = WIDTH) -> DataFrame:
    """Slots that a batch of ``key, value, at, step`` events touched, with all they hold; ``step`` is +1 or -1."""
    slotted = events.select("key", F.floor(F.col("value") / width).alias("slot"), "value", "at", "step")
    return slotted.groupBy("key", "slot").transformWithStateInPandas(Counts(), TOUCHED, "Update", "None")


def _slots(spark: SparkSession, path: str, batch: int) -> DataFrame:
    return spark.read.schema(SLOTS).parquet(f"{path}/slots/batch={batch}") if batch >= 0 else spark.createDataFrame([], SLOTS)


def lower_medians(spark: SparkSession, path: str, batch: int) -> DataFrame:
    """Size and left-middle value of every multiset that is not empty, after a batch."""
    slots = _slots(spark, path, batch)
    # a row per slot, not per value
    so_far = W.partitionBy("key").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    slots = slots.withColumns({"before": F.coalesce(F.sum("size").over(so_far), F.lit(0)), "total": F.sum("size").over(W.partitionBy("key"))})
    at = F.floor((F.col("total") - 1) / 2)
    wanted = slots.where((F.col("before") <= at) & (at < F.col("before") + F.col("size"))).select("key", "slot", "written", "total", (at - F.col("before")).alias("place"))
    held = spark.read.schema(TOUCHED + ", batch bigint").option("basePath", f"{path}/touched").parquet(f"{path}/touched/batch=*")
    hit = wanted.join(held.withColumnRenamed("batch", "written"), ["key", "slot", "written"])
    running = F.aggregate("counts", F.struct(F.lit(0).cast("bigint").alias("upto"), F.lit(None).cast("bigint").alias("value")),
                          lambda acc, x: F.struct((acc["upto"] + x["n"]).alias("upto"), F.when((acc["value"].isNull()) & (F.col("place") < acc["upto"] + x["n"]), x["value"])
                                                  .otherwise(acc["value"]).alias("value")))
    return hit.select("key", F.col("total").alias("size"), running["value"].alias("median"))


def current(spark: SparkSession, path: str, batch: int) -> DataFrame:
    """``key, value, n`` of all multisets after a batch."""
    slots = _slots(spark, path, batch).select("key", "slot", "written")
    held = spark.read.schema(TOUCHED + ", batch bigint").option("basePath", f"{path}/touched").parquet(f"{path}/touched/batch=*")
    rows = slots.join(held.withColumnRenamed("batch", "written"), ["key", "slot", "written"])
    return rows.select("key", F.explode("counts").alias("c")).select("key", "c.value", "c.n")


def _write(df: DataFrame, batch: int, path: str) -> None:
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}/touched/batch={batch}")
    new = spark.read.schema(TOUCHED).parquet(f"{path}/touched/batch={batch}").select("key", "slot", "size", F.lit(batch).cast("bigint").alias("written"))
    kept = _slots(spark, path, batch - 1).join(new.select("key", "slot"), ["key", "slot"], "left_anti")
    kept.unionByName(new.where("size > 0")).write.mode("overwrite").parquet(f"{path}/slots/batch={batch}")
    lower_medians(spark, path, batch).write.mode("overwrite").parquet(f"{path}/medians/batch={batch}")


def start_multisets(events: DataFrame, path: str, checkpoint: str, width: int = WIDTH) -> StreamingQuery:
    """Slots, sizes and medians after every batch below ``path``; events come in order from batch to batch."""
    spark = events.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return (touched(events, width).writeStream.outputMode("update").foreachBatch(lambda df, i: _write(df, i, path))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def last_batch(spark: SparkSession, path: str) -> int:
    """Number of the last batch that was written whole."""
    found = [int(c.partition("=")[2]) for c in folders.children(spark, f"{path}/medians") if c.startswith("batch=")]
    return max((b for b in found if folders.exists(spark, f"{path}/medians/batch={b}/_SUCCESS")), default=-1)
