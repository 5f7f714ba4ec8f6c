"""Percentiles of any span of files from one stored sketch per file.

A sketch is a summary of fixed size from which quantiles are read within an
error of rank; sketches of parts merge into the sketch of the whole.  So the
values are read once, when a file arrives, and a question about any span of
files reads as many rows as there are files in it.  :mod:`ranking` has the
exact form, which stays the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.sinks import folders

#: size of a sketch; more is more exact
K = 400
SKETCHES = "file string, n bigint, sketch binary"


def rank_error(k: int = K) -> float:
    """Bound of the error of a rank, as a share of all values, that holds with 99 % confidence for one quantile."""
    return 2.296 / k ** 0.9021


def file_sketches(df: DataFrame, value: Column, k: int = K) -> DataFrame:
    """A sketch per input file of a table that is read from files; rows without a value don't count."""
    return _sketched(file_values(df, value), k)


def file_values(df: DataFrame, value: Column) -> DataFrame:
    return df.select(F.col("_metadata.file_path").alias("file"), value.cast("double").alias("v")).where("v is not null and not isnan(v)")


def _sketched(rows: DataFrame, k: int) -> DataFrame:
    return rows.groupBy("file").agg(F.count("*").alias("n"), F.kll_sketch_agg_double("v", F.lit(k)).alias("sketch"))


def store_sketches(df: DataFrame, value: Column, path: str, k: int = K) -> None:
    """Sketches of the files that are not in the table at ``path`` yet; other files are not read."""
    spark = df.sparkSession
    found = file_values(df, value)
    if folders.exists(spark, path):
        # names of files, one row each
        known = [r["file"] for r in spark.read.schema(SKETCHES).parquet(path).select("file").collect()]
        found = found.where(~F.col("file").isin(known)) if known else found
    _sketched(found, k).write.mode("append").parquet(path)


def sketched_percentiles(sketches: DataFrame, shares: list[float]) -> DataFrame:
    """Share and approximate value over all files of a table of sketches; no values give no rows."""
    merged = sketches.agg(F.kll_merge_agg_double("sketch").alias("s"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    at = F.array(*map(F.lit, shares))
    pairs = F.arrays_zip(at.alias("share"), F.kll_sketch_get_quantile_double("s", at).alias("value"))
    return merged.where("n > 0").select(F.explode(pairs).alias("p")).select("p.share", "p.value")


def rank_gap(df: DataFrame, value: Column, found: DataFrame) -> DataFrame:
    """How far the approximate values are from the wanted ranks: one pass that counts, per share, the rows around its value.

    A value that many rows have covers all their ranks; the gap is to the nearest of them.
    """
    rows = found.collect()  # a row per share
    v = value.cast("double")
    sums = [x for r in rows for x in (F.count_if(v < r["value"]), F.count_if(v <= r["value"]))]
    counts = df.where(v.isNotNull() & ~F.isnan(v)).agg(F.count("*"), *sums).first()
    n, out = counts[0], []
    for i, r in enumerate(rows):
        below, upto = counts[1 + 2 * i], counts[2 + 2 * i]
        at = r["share"] * (n - 1)
        out.append((r["share"], r["value"], max(below - at, at - max(upto - 1, below), 0.0) / max(n, 1)))
    return df.sparkSession.createDataFrame(out, "share double, value double, gap double")
