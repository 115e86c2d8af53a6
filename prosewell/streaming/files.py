"""File streams in and out: what every stream of this package shares.

A stream reads files as they arrive and writes with the file sink, whose own log names the files of each committed batch. A batch that was
killed midway leaves files the log does not name: readers of the folder do not see them, and the batch is written again when the stream
goes on. So no row is doubled or lost, without any code for it here.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _is_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def arriving(
    spark: SparkSession, source: str, schema: str | T.StructType, files_per_batch: int
) -> DataFrame | None:
    """The stream of the Parquet files under `source`; None where there is no such folder yet."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    try:
        return reader.parquet(source)
    except AnalysisException as error:
        if _is_missing(error):
            return None
        raise


@contextmanager
def settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """The session with other settings for a while."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def run_to_sink(stream: DataFrame, target: str, wanted: Mapping[str, str] | None = None) -> None:
    """Process all that has arrived, in as many batches as it takes, and stop. Goes on from where the last call stopped.

    State has a partition per core of the cluster that runs the first batch: each costs a store of its own in every batch, however little it holds.
    """
    spark = stream.sparkSession
    cores = {"spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism)}
    writer = stream.writeStream.format("parquet").outputMode("append")
    with settings(spark, cores | dict(wanted or {})):
        running = (
            writer.option("path", f"{target}/rows")
            .option("checkpointLocation", f"{target}/progress")
            .trigger(availableNow=True)
            .start()
        )
        running.awaitTermination()


def landed(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """All rows of committed batches; an empty table before the first."""
    try:
        return spark.read.schema(schema).parquet(f"{target}/rows")
    except AnalysisException as error:
        if _is_missing(error):
            return spark.createDataFrame([], schema)
        raise
