"""Messages routed by the status of their key: new, incomplete, complete or failed.

Every batch first takes the earliest message of each key, so that a second one
in the same batch finds the key complete.  Statuses live in an append-only log
in which the newest row of a key wins.  The log has a folder per bucket of keys,
and a batch reads only the buckets of its own keys.  All outputs are folders per batch, so a
batch that is run again replaces what it wrote.  Every so many batches the log
is folded into one row per key, which starts a new generation of the log.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.relational import match, union_all
from millrace.sinks import folders
from millrace.sinks.writes import newest

STATUS = "uid string, data string, status string, seq int, gen int, batch bigint, bucket int"
#: buckets of keys; a table keeps the number that it is begun with
BUCKETS = 64


def bucket_of(uid: Column) -> Column:
    return F.pmod(F.xxhash64(uid), F.lit(BUCKETS)).cast("int")


def write_log(rows: DataFrame, path: str) -> None:
    """Log rows in a folder per bucket of keys, one file each."""
    rows = rows.withColumn("bucket", bucket_of(F.col("uid")))
    rows.repartition("bucket").write.mode("overwrite").partitionBy("bucket").option("partitionOverwriteMode", "static").parquet(path)


def validated(messages: DataFrame) -> DataFrame:
    """Adds ``uid``; messages without one carry the failed step."""
    uid = F.col("attributes")["uid"]
    # tells copies of one message apart; which copy gets which number does not matter
    number = F.monotonically_increasing_id().alias("number")
    return messages.select("data", "attributes", "publish_time", number, uid.alias("uid"),
                           F.when(uid.isNull(), "extractElement").alias("step_name"))


def classified(messages: DataFrame, statuses: DataFrame) -> DataFrame:
    """Route per valid message: ``new``, ``inComplete`` or ``complete`` (seen before)."""
    order = F.struct("publish_time", "data", "number")
    first = messages.groupBy(F.col("uid").alias("f_uid")).agg(F.min(order).alias("f_order"))
    known = statuses.select(F.col("uid").alias("k_uid"), F.col("status").alias("k_status"))
    state = match(first, known, "left", f_uid="k_uid")
    s = match(messages, state, uid="f_uid")
    is_first = order == F.col("f_order")
    route = (F.when(~is_first, "complete").when(F.col("k_uid").isNull(), "new")
             .when(F.col("k_status") != "complete", "inComplete").otherwise("complete"))
    return s.withColumn("route", route).select("uid", F.decode("data", "UTF-8").alias("data"), "attributes", "publish_time", "route")


def status_rows(routed: DataFrame, two_phase: bool) -> DataFrame:
    """Log rows of a batch; with two phases a new key is first inserted as ``new``."""
    done = routed.where("route <> 'complete'").select("uid", "data", F.lit("complete").alias("status"), F.lit(1).alias("seq"))
    if not two_phase:
        return done
    opened = routed.where("route = 'new'").select("uid", "data", F.lit("new").alias("status"), F.lit(0).alias("seq"))
    return union_all(opened, done)


def accepted(rows: DataFrame) -> DataFrame:
    """Adds ``rejected`` to rows that do not fit the sink: its key is a number."""
    return rows.withColumn("rejected", F.expr("try_cast(uid as bigint)").isNull())


def generation(spark: SparkSession, path: str) -> int:
    """Newest generation whose folded rows are completely written."""
    found = [int(c[4:]) for c in folders.children(spark, path) if c.startswith("gen=")]
    return max([g for g in found if folders.exists(spark, f"{path}/gen={g}/batch=-1/_SUCCESS")], default=0)


def read_log(spark: SparkSession, path: str, before: int | None = None, gen: int | None = None) -> DataFrame:
    """Log rows of all generations or of one; ``batch`` -1 holds folded or seeded rows."""
    if not folders.children(spark, path) or (gen is not None and not folders.exists(spark, f"{path}/gen={gen}")):
        return spark.createDataFrame([], STATUS)
    reader = spark.read.schema(STATUS).option("basePath", path)
    log = reader.parquet(path if gen is None else f"{path}/gen={gen}")
    return log if before is None else log.where(F.col("batch") < before)


def current_status(spark: SparkSession, path: str, before: int | None = None, buckets: list[int] | None = None) -> DataFrame:
    """Newest row per key; reads only the current generation, and of it only some buckets of keys if they are named."""
    log = read_log(spark, path, before, generation(spark, path))
    log = log if buckets is None else log.where(F.col("bucket").isin(buckets))
    return newest(log.select("uid", "data", "status", "seq", "batch"), "uid", ["batch", "seq"])


def seed_status(rows: DataFrame, path: str) -> None:
    """Statuses known before the stream starts: uid, data, status."""
    write_log(rows.withColumn("seq", F.lit(0)), f"{path}/gen=0/batch=-1")


def fold_status(spark: SparkSession, path: str, before: int) -> int:
    """Start a generation with one row per key known before a batch; safe to repeat."""
    gen = generation(spark, path) + 1
    rows = current_status(spark, path, before).select("uid", "data", "status", "seq")
    write_log(rows, f"{path}/gen={gen}/batch=-1")
    return gen


def route_batch(batch: DataFrame, batch_id: int, out: str, two_phase: bool = False, fold_every: int = 100) -> None:
    spark = batch.sparkSession
    if batch_id > 0 and batch_id % fold_every == 0:
        fold_status(spark, f"{out}/status", batch_id)
    gen = generation(spark, f"{out}/status")
    # the batch feeds four writes
    batch = batch.persist()
    try:
        checked = validated(batch)
        keyed = checked.where("step_name is null")
        buckets = [r[0] for r in keyed.select(bucket_of(F.col("uid"))).distinct().collect()]  # BUCKETS at most
        status = current_status(spark, f"{out}/status", before=batch_id, buckets=buckets)
        routed = classified(checked.where("step_name is null").drop("step_name"), status).persist()
        try:
            sink = accepted(routed.where("route = 'complete'").select("uid", "data", F.lit("complete").alias("status"), "attributes"))
            failed = checked.where("step_name is not null").select(
                F.decode("data", "UTF-8").alias("data"), "attributes", "step_name")
            rejected = sink.where("rejected").select("data", "attributes", F.lit("write").alias("step_name"))
            writes = {"duplicates": sink.where("not rejected").select("uid", "data", "status"),
                      "dead_letters": union_all(failed, rejected)}
            write_log(status_rows(routed, two_phase), f"{out}/status/gen={gen}/batch={batch_id}")
            for name, df in writes.items():
                df.write.mode("overwrite").parquet(f"{out}/{name}/batch={batch_id}")
        finally:
            routed.unpersist()
    finally:
        batch.unpersist()


def start_routing(messages: DataFrame, out: str, checkpoint: str, two_phase: bool = False,
                  fold_every: int = 100) -> StreamingQuery:
    return (messages.writeStream.foreachBatch(lambda df, i: route_batch(df, i, out, two_phase, fold_every))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
