"""File sources: JSON documents, JSON lines, CSV dialects, text and Parquet folders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from millrace.plans.star.tables import Star, TABLES


def positional_json(spark: SparkSession, path: str, fields: list[tuple[str, str]], field: str = "data") -> DataFrame:
    """Rows of a JSON document whose ``field`` holds one array of values per row."""
    docs = spark.read.schema(f"{field} array<array<string>>").option("recursiveFileLookup", True).json(path, multiLine=True)
    rows = docs.select(F.explode(field).alias("v"))
    return rows.select(*[F.get("v", F.lit(i)).cast(kind).alias(name) for i, (name, kind) in enumerate(fields)])


def json_lines(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def append_json(spark: SparkSession, path: str, schema: StructType | str, target: str) -> None:
    """Load JSON lines of a known schema at the end of a Parquet table."""
    json_lines(spark, path, schema).write.mode("append").parquet(target)


def csv_with_header(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=True)


def csv_plain(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.format("csv").schema(schema).load(path)


def pipe_delimited(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Pipe-separated values without quoting; a closing separator adds nothing."""
    return spark.read.csv(path, sep="|", quote="", schema=schema)


def stacked_csv(spark: SparkSession, paths: list[str], flag: str, sep: str = ";") -> DataFrame:
    """CSV files of one layout under each other, flagged 0, 1, ... by file."""
    frames = []
    for i, path in enumerate(paths):
        df = spark.read.csv(path, header=True, inferSchema=True, sep=sep)
        frames.append(df.toDF(*[c.replace(" ", "_") for c in df.columns]).withColumn(flag, F.lit(i)))
    return reduce(DataFrame.unionByName, frames)


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def register_tables(spark: SparkSession, path: str, names: tuple[str, ...] = TABLES) -> Star:
    """Parquet folder per table, each registered under its name."""
    star = Star.stored(spark, path)
    for name in names:
        star.table(name).createOrReplaceTempView(name)
    return star


def daily_logs(spark: SparkSession, paths: str, pattern: str = r"_([0-9]{8})[_.]") -> DataFrame:
    """Log lines of the files that match a path, with ``dt`` cut out of the name of the file they came from."""
    lines = spark.read.text(paths)
    return lines.select("value", F.regexp_extract(F.col("_metadata.file_name"), pattern, 1).alias("dt"))


def projected(df: DataFrame, fields: list[str], restriction: str) -> DataFrame:
    """Only the named fields of the rows that pass; both reach the scan."""
    return df.where(restriction).select(*fields)


def table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def job_config(spark: SparkSession, path: str, names: list[str] | None = None) -> DataFrame:
    """Configuration sheet: header row, and rows that may stop short of it; with ``names`` the files have no header row."""
    df = spark.read.csv(path, schema=", ".join(f"`{x}` string" for x in names)) if names else spark.read.csv(path, header=True)
    return df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in df.columns])


def numbered_messages(spark: SparkSession, n: int) -> DataFrame:
    """Test messages numbered from 1."""
    return spark.range(1, n + 1).select(F.format_string("Message number %d", "id").cast("binary").alias("data"))


def numbered_rows(spark: SparkSession, first: int, end: int) -> DataFrame:
    """Rows ``(i, 'string_value_i')`` for ``first <= i < end``."""
    return spark.range(first, end).select(F.col("id").alias("num"), F.format_string("string_value_%d", "id").alias("text"))


def struct_rows(spark: SparkSession, structs: list[dict]) -> DataFrame:
    """An array-of-struct query parameter as rows."""
    parameter = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in s.items()]) for s in structs])
    return spark.sql("select inline(:structs)", args={"structs": parameter})
