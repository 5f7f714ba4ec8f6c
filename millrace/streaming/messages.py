"""Unbounded message sources: payload, attributes and publish time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

MESSAGE = "data binary, attributes map<string,string>, publish_time timestamp"


def message_files(spark: SparkSession, path: str, per_batch: int | None = None) -> DataFrame:
    """Messages that arrive as Parquet files in a folder."""
    reader = spark.readStream.schema(MESSAGE)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    return reader.parquet(path)


def kafka_messages(spark: SparkSession, servers: str, topic: str | None = None, pattern: str | None = None,
                   **options: str) -> DataFrame:
    """Messages of a topic, or of all topics that match a pattern; headers become attributes."""
    if (topic is None) == (pattern is None):
        raise ValueError("name either a topic or a pattern")
    source = ("subscribe", topic) if topic else ("subscribePattern", pattern)
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option(*source)
           .option("includeHeaders", "true").options(**options).load())
    attributes = F.map_from_entries(F.transform("headers", lambda h: F.struct(h["key"], h["value"].cast("string"))))
    return raw.select(F.col("value").alias("data"), attributes.alias("attributes"), F.col("timestamp").alias("publish_time"))


def table_stream(spark: SparkSession, folder: str, name: str, schema) -> DataFrame:
    """One raw table, a file or a folder of files, as a stream."""
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parquet*")


def decoded(messages: DataFrame) -> DataFrame:
    return messages.withColumn("line", F.decode("data", "UTF-8"))
