"""Reliable storage for results that are read more than once.

Lineage is cut with `checkpoint()` into the shared folder named by
`spark.checkpoint.dir`, so a lost executor never forces an iterative job to
start again from the raw text.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a local session may fall back to a temporary one."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="prosewell-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """Materialize `df` in the shared folder and drop its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
