"""Documents to training data: rules, one of each near-duplicate group, decontamination, redaction, mixing.

Every stage takes all rows its predecessor kept and returns the columns of
``documents``; the last one adds the copy number and the place in the shuffle.
Null texts count as empty and fail the quality rules; empty tables pass through
as empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, mixing, neardup, private, quality
from millrace.llm.text import read
from millrace.session import configure, materialized


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.kept(docs, read(configure(spark), sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays; five-word shingles, similarity 0.8 or more."""
    configure(spark)
    return neardup.representatives(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.clean(docs, read(configure(spark), sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    configure(spark)
    return private.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources get equal shares of the characters."""
    configure(spark)
    return mixing.replicated(docs)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("decontaminated", decontaminated),
          ("personal_data", personal_data), ("mixed", mixed)]

#: the learned rules and the spans of the bootstrap have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialized(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
