"""Event-time windows over arriving files, with a watermark and a ledger of what came too late.

Two streams read the same files. One counts rows by window and key and writes a window when the watermark has passed its end; a row whose window ended before
the watermark of the batch before its own is too late and changes nothing any more. The other, without state, enters every row's window
in the ledger. What the ledger has of a closed window beyond its count came late, so late rows are counted, never lost unseen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prosewell.operators.joins import names
from prosewell.streaming.files import arriving, landed, run_to_sink


def _timed(stream: DataFrame, time: str) -> DataFrame:
    return stream.withColumn("_time", F.col(f"`{time}`").cast("timestamp")).filter(F.col("_time").isNotNull())


def _counts(stream: DataFrame, window: Column, by: Sequence[str], value: str) -> DataFrame:
    return (
        stream.groupBy(window.alias("_window"), *by)
        .agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col(f"`{value}`").cast("double")).alias("total"))
        .select(F.col("_window.start").alias("start"), F.col("_window.end").alias("end"), *by, "rows", "total")
    )


def _run(
    spark: SparkSession, source: str, schema: str, target: str, files_per_batch: int, plan, nothing: DataFrame
) -> DataFrame:
    stream = arriving(spark, source, schema, files_per_batch)
    if stream is not None:
        run_to_sink(plan(stream), target)
    return landed(spark, target, plan(nothing).schema)


def tumbling_windows(
    spark: SparkSession,
    source: str,
    schema: str,
    target: str,
    time: str,
    by: str | Sequence[str],
    value: str,
    width: str,
    delay: str,
    files_per_batch: int = 1000,
) -> DataFrame:
    """(start, end, by, arrived, rows, total, late, closed): every window that a row has arrived for.

    `rows` and `total` (the sum of `value`, 0 of nothing) are those of the rows in time, and null while the window is open: until the watermark, `delay` behind the latest
    time seen, has passed its end. `late` counts the rows that arrived for a closed window but are not in `rows`. Windows begin at multiples of `width`. Rows without a time are in
    no window; null keys are a key. Call again with the same `target` to go on with files that have arrived since; nothing arrived gives an empty table.
    """
    by = names(by)
    kind = spark.createDataFrame([], schema).schema
    nothing = spark.createDataFrame([], kind)

    def counted(stream: DataFrame) -> DataFrame:
        timed = _timed(stream, time).withWatermark("_time", delay)
        return _counts(timed, F.window("_time", width), by, value)

    def entered(stream: DataFrame) -> DataFrame:
        window = F.window("_time", width)
        return _timed(stream, time).select(window.alias("_window"), *by).select(
            F.col("_window.start").alias("start"), F.col("_window.end").alias("end"), *by
        )

    args = spark, source, schema
    windows = _run(*args, f"{target}/windows", files_per_batch, counted, nothing)
    # The ledger comes second: it knows every row that the windows know.
    ledger = _run(*args, f"{target}/ledger", files_per_batch, entered, nothing)
    arrived = ledger.groupBy("start", "end", *by).agg(F.count(F.lit(1)).alias("arrived"))
    last = windows.agg(F.max("end").alias("_last"))
    key = [F.col(f"a.`{c}`").eqNullSafe(F.col(f"w.`{c}`")) for c in ["start", "end", *by]]
    matched = arrived.alias("a").join(windows.alias("w"), key, "left")
    # A closed window without a row in time was never written, but a later one was.
    closed = F.coalesce(F.col("a.end") <= F.lit(last.first()[0]).cast(T.TimestampType()), F.lit(False))
    return matched.select(
        *(F.col(f"a.`{c}`") for c in ["start", "end", *by, "arrived"]),
        F.when(closed, F.coalesce("w.rows", F.lit(0))).alias("rows"),
        F.when(closed, F.coalesce("w.total", F.lit(0.0))).alias("total"),
        F.when(closed, F.col("a.arrived") - F.coalesce("w.rows", F.lit(0))).otherwise(0).alias("late"),
        closed.alias("closed"),
    )


def session_windows(
    spark: SparkSession,
    source: str,
    schema: str,
    target: str,
    time: str,
    by: str | Sequence[str],
    value: str,
    gap: str,
    delay: str,
    files_per_batch: int = 1000,
) -> DataFrame:
    """(start, end, by, rows, total): the closed sessions of each key; a session ends `gap` after its last row.

    A session is closed when the watermark has passed its end. Rows that come too late for it change nothing. As the batch form, `temporal.sessions`, has the
    last row's time for an end and joins rows exactly `gap` apart, a session there ends `gap` earlier.
    """
    by = names(by)
    nothing = spark.createDataFrame([], schema)

    def counted(stream: DataFrame) -> DataFrame:
        timed = _timed(stream, time).withWatermark("_time", delay)
        return _counts(timed, F.session_window("_time", gap), by, value)

    return _run(spark, source, schema, target, files_per_batch, counted, nothing)
