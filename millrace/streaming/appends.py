"""Continuous small appends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.sinks import folders

#: a committed batch: its offsets run from ``first`` to before ``next``
LEDGER = "batch bigint, first bigint, next bigint"


def append_rows(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Rows of every micro-batch added to a table exactly once by the file sink."""
    return (stream.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """Committed batches of a table that :func:`append_batches` writes."""
    return spark.read.schema(LEDGER).parquet(f"{path}/ledger/*")


def next_offset(spark: SparkSession, path: str, batch: int) -> int:
    """Where a batch begins: after the last offset of the batch before, which is all that is read."""
    if batch == 0:
        return 0
    before = f"{path}/ledger/{batch - 1}"
    if not folders.exists(spark, f"{before}/_SUCCESS"):
        raise ValueError(f"batch {batch - 1} of {path} is not committed")
    return spark.read.schema(LEDGER).parquet(before).first()["next"]


def append_batch(df: DataFrame, batch: int, path: str) -> None:
    """All rows of a batch under its number, then its line in the ledger; if it is run again it replaces both."""
    spark = df.sparkSession
    first = next_offset(spark, path, batch)
    # the number of a row in its partition is in the low 33 bits
    rows = df.withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}).persist()
    try:
        starts, at = [], first
        for part, n in sorted(rows.groupBy("part").count().collect()):  # one row per partition
            starts.append((part, at))
            at += n
        base = spark.createDataFrame(starts, "part int, base bigint")
        out = rows.join(base, "part").withColumn("row_offset", F.col("base") + F.col("place")).drop("part", "place", "base")
        out.write.mode("overwrite").parquet(f"{path}/rows/batch={batch}")
    finally:
        rows.unpersist()
    spark.createDataFrame([(batch, first, at)], LEDGER).coalesce(1).write.mode("overwrite").parquet(f"{path}/ledger/{batch}")


def append_batches(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """All-or-nothing batches with offsets that run on from batch to batch; readers take the batches of the ledger."""
    return (stream.writeStream.foreachBatch(lambda df, i: append_batch(df, i, path)).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def committed(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the committed batches."""
    done = ledger(spark, path).select("batch")
    return spark.read.option("basePath", f"{path}/rows").parquet(f"{path}/rows").join(done, "batch", "left_semi")
