"""Feature stages: indexes, one-hot codes, vectors and scaling."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml.feature import (OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler, VectorIndexer,
                                VectorSizeHint)
from pyspark.sql import Column, DataFrame, functions as F

from millrace.session import materialized

#: rows that are worth a task of their own where a fit passes over them hundreds of times
PART_ROWS = 200_000


def mixed_features(categorical: list[str], numeric: list[str], label: str, out: str = "features") -> Pipeline:
    """Index and one-hot encode the categories, index the label, put all into one vector."""
    index = StringIndexer(inputCols=categorical, outputCols=[c + "Index" for c in categorical], handleInvalid="keep")
    encode = OneHotEncoder(inputCols=[c + "Index" for c in categorical], outputCols=[c + "Vec" for c in categorical])
    target = StringIndexer(inputCol=label, outputCol="label")
    gather = VectorAssembler(inputCols=[c + "Vec" for c in categorical] + numeric, outputCol=out)
    return Pipeline(stages=[index, encode, target, gather])


def indexed(df: DataFrame, columns: list[str], suffix: str = "_idx") -> DataFrame:
    """Frequency index of text columns; rows with an unknown value are skipped."""
    stage = StringIndexer(inputCols=columns, outputCols=[c + suffix for c in columns], handleInvalid="skip")
    return stage.fit(df).transform(df)


def assembled(columns: list[str], out: str = "rawFeatures") -> VectorAssembler:
    return VectorAssembler(inputCols=columns, outputCol=out)


def category_indexed(columns: list[str], categories: int = 4) -> list:
    """Assemble, then treat features with few values as categories."""
    return [assembled(columns), VectorIndexer(inputCol="rawFeatures", outputCol="features", maxCategories=categories, handleInvalid="keep")]


def sized(column: str, size: int) -> VectorSizeHint:
    """Declares a vector length, which a stream cannot find out by looking."""
    return VectorSizeHint(inputCol=column, size=size, handleInvalid="error")


def standardised(train: DataFrame, *others: DataFrame, column: str = "rawFeatures", out: str = "scaled") -> list[DataFrame]:
    """Centre and scale by the training rows only."""
    model = StandardScaler(inputCol=column, outputCol=out, withMean=True, withStd=True).fit(train)
    return [model.transform(df) for df in (train, *others)]


def weighed(rows: DataFrame, columns: list[str], weight: str = "weight", **deals: Column) -> DataFrame:
    """One row for all that are alike in what a model sees, with their number as its weight.

    A weighted sum over these rows is the sum over all rows, so losses, gradients and curves stay what they are.
    ``deals`` (folds, pieces) are further columns that keep rows apart.
    """
    return rows.groupBy(*columns, *[c.alias(name) for name, c in deals.items()]).agg(F.count("*").cast("double").alias(weight))


def weighed_values(rows: DataFrame, columns: list[str], label: str, weight: str = "weight", **deals: Column) -> DataFrame:
    """Rows alike in ``columns`` as two, a deviation of the label below and above its mean, each with half their number as weight.

    Number, sum and sum of squares of the label are those of the rows, and squared errors and gains of splits follow from
    these.  Rows with one label stay one row, and those without a label are kept apart.
    """
    alike = rows.groupBy(*columns, *[c.alias(name) for name, c in deals.items()], F.isnull(label).alias("_none")).agg(
        F.count("*").alias("_n"), F.avg(label).alias("_mean"), F.stddev_pop(label).alias("_dev"))
    sides = F.when(F.col("_dev") > 0, F.array(F.lit(-1.0), F.lit(1.0))).otherwise(F.array(F.lit(0.0)))
    out = alike.withColumn("_sides", sides).select("*", F.explode("_sides").alias("_side"))
    out = out.withColumns({label: F.col("_mean") + F.col("_side") * F.coalesce("_dev", F.lit(0.0)), weight: F.col("_n") / F.size("_sides")})
    return out.drop("_none", "_n", "_mean", "_dev", "_sides", "_side")


def packed(rows: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """All rows, stored once, in as many parts as they fill.

    Each step of a fit is a job over all parts; over parts of few rows, starting the tasks costs more than their work.
    """
    stored = materialized(rows)
    return stored.coalesce(max(1, math.ceil(stored.count() / part_rows)))
