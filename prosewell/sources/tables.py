"""Parquet tables in, with enough partitions to use the whole cluster."""

from __future__ import annotations

from collections.abc import Sequence
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosewell.operators.joins import names

# Bytes of files whose rows `deal` gives to a task.
TASK_BYTES = 8 * 1024 * 1024


@lru_cache(maxsize=256)
def _bytes(spark: SparkSession, files: tuple[str, ...]) -> int:
    return spark.read.format("binaryFile").load(list(files)).agg(F.sum("length")).first()[0]


def fan_out(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Spread a small table over all cores.

    A table of a few small files scans as fewer tasks than there are cores. Such
    a table is hashed by its key, which later aggregates by the same key reuse.
    A table with a file per core, or with more bytes than the cores read in one
    wave, already scans in parallel and is returned as it is: no shuffle.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    files = df.inputFiles()
    if not files or len(files) >= cores:
        return df
    if _bytes(spark, tuple(files)) >= cores * 128 * 1024 * 1024:
        return df
    return df.repartition(cores, *names(key))


def deal(df: DataFrame, key: str | Sequence[str], task_bytes: int | None = None) -> DataFrame:
    """A table moved once so that all rows of a key are in one partition and no partition holds more than its share of some 8 MB of files.

    For steps that hold what a task has read, such as counts by key and word: the number of tasks grows with the input, their memory does not. What
    groups by the key and more, or sorts within it, then moves nothing.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    files = df.inputFiles()
    parts = -(-_bytes(spark, tuple(files)) // (task_bytes or TASK_BYTES)) if files else 1
    return df.repartition(max(cores, parts), *names(key))


def read_table(
    spark: SparkSession, folder: str, name: str, key: str | Sequence[str] | None = None
) -> DataFrame:
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    return df if key is None else fan_out(df, key)


def documents_as_corpus(spark: SparkSession, folder: str, label: str = "toxic") -> DataFrame:
    """(doc_id, label, text): every document, with its label where one was given.

    The label table is as long as the document table can get, so the join is left to
    the optimizer's own size check: broadcast when small, shuffled on doc_id otherwise.
    """
    docs = read_table(spark, folder, "documents", "doc_id").select("doc_id", "text")
    labels = read_table(spark, folder, "labels").select("doc_id", F.col(label).alias("label"))
    return docs.join(labels, "doc_id", "left").select("doc_id", "label", "text")
