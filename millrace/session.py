"""Session settings the jobs rely on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# read by the jobs, not by the cluster: safe to set on a shared session
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # else one task does the joins of all branches of a union, one partition of each
    "spark.sql.unionOutputPartitioning": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local(cores: int | str = "*", app: str = "millrace") -> SparkSession:
    """Session for tests and the local bench."""
    spark = (SparkSession.builder.master(f"local[{cores}]").appName(app)
             .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
             .config("spark.driver.memory", os.environ.get("MILLRACE_DRIVER_MEMORY", "12g"))
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """Folder that driver and executors share: the setting ``spark.checkpoint.dir``, or what ``setCheckpointDir`` set.

    A folder is made up only in a local session, as in tests.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if found is None:
        if not re.match(r"local(\[[^-]|$)", context.master):
            raise ValueError("name a folder that all executors share: spark.checkpoint.dir or setCheckpointDir")
        found = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        context.setCheckpointDir(found)
    return found.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """New folder for intermediate files, below the shared folder of the session."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialized(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder of the session.

    Used where one input feeds several passes, so that they all see the same
    rows and an executor loss does not redo the input.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def shuffle_parts(spark: SparkSession) -> int:
    """Parts that a shuffle of this session has; splits that must grow with the cluster follow it."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
