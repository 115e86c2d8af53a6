"""Registered queries: streams over `events` and `conversations`, run to the end of what has arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosewell.operators import temporal
from prosewell.plans import fixtures as fx
from prosewell.plans.registry import query
from prosewell.plans.sentiment import TURN_LEXICON, _turn_sql
from prosewell.sources.store import fresh_path
from prosewell.sources.tables import read_table
from prosewell.streaming import windows
from prosewell.streaming.running import running_polarity

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
# Files arrive every three days; one event in thirteen arrives late by a week. Windows are a day, the watermark two days behind.
ARRIVAL_DAYS, LATE_EACH, LATE_DAYS, DELAY_DAYS = 3, 13, 7, 2


def arrivals(spark: SparkSession, folder: str, files: int = 1) -> tuple[str, DataFrame]:
    """A folder in which the events arrive batch by batch, `files` files each, and the events with their batch."""
    rows = read_table(spark, folder, "events")
    late = F.when(F.col("event_id") % LATE_EACH == 0, LATE_DAYS).otherwise(0)
    day = F.datediff(F.col("ts"), F.lit("2024-01-01")) + late
    rows = rows.withColumn("batch", F.floor(day / ARRIVAL_DAYS))
    source = fresh_path(spark, "arrivals")
    for number in sorted(r[0] for r in rows.select("batch").distinct().collect()):
        batch = rows.filter(F.col("batch") == number).drop("batch")
        batch.repartition(files).write.mode("append").parquet(source)
    return source, rows


# The watermark that makes a row late is that of the batch before its own: from the times of all batches but the last two.
WINDOWS_SQL = f"""WITH arrived AS (SELECT *, time_bucket(INTERVAL 1 DAY, ts) AS s, floor((date_diff('day', DATE '2024-01-01', ts::DATE)
      + CASE WHEN event_id % {LATE_EACH} = 0 THEN {LATE_DAYS} ELSE 0 END) / {ARRIVAL_DAYS}) AS batch FROM events),
    batches AS (SELECT batch, max(max(ts)) OVER (ORDER BY batch) - INTERVAL {DELAY_DAYS} DAY AS mark, row_number() OVER (ORDER BY batch) AS no FROM arrived GROUP BY batch),
    judged AS (SELECT a.*, coalesce(s + INTERVAL 1 DAY <= date_trunc('millisecond', w.mark), false) AS late FROM arrived a JOIN batches b USING (batch) LEFT JOIN batches w ON w.no = b.no - 2),
    counted AS (SELECT s, event_type, count(*) AS arrived, count(*) FILTER (NOT late) AS n, sum(value) FILTER (NOT late) AS total FROM judged GROUP BY ALL),
    closing AS (SELECT max(s) AS last FROM counted WHERE n > 0 AND s + INTERVAL 1 DAY <= (SELECT date_trunc('millisecond', max(mark)) FROM batches))
    SELECT epoch_us(s) AS started, event_type, arrived, CASE WHEN s <= last THEN n END AS rows, CASE WHEN s <= last THEN round(coalesce(total, 0), 4) END AS total,
      CASE WHEN s <= last THEN arrived - n ELSE 0 END AS late, s <= last AS closed FROM counted, closing"""


@query("K4_event_time_windows", WINDOWS_SQL)
def k4(spark, folder):
    """Daily counts by type of events that arrive in batches, some of them late."""
    source, _ = arrivals(spark, folder)
    target = fresh_path(spark, "windows")
    by_day = "1 day", f"{DELAY_DAYS} days"
    out = windows.tumbling_windows(spark, source, EVENTS, target, "ts", "event_type", "value", *by_day, files_per_batch=1)
    started = temporal.instant(out, "start").alias("started")
    return out.select(
        started, "event_type", "arrived", "rows", F.round("total", 4).alias("total"), "late", "closed"
    )


@query("K5_running_polarity", _turn_sql("conv_id"))
def k5(spark, folder):
    """Polarity of every conversation after its turns have arrived in three files, kept as state in between."""
    turns = read_table(spark, folder, "conversations")
    source = fresh_path(spark, "turns")
    for part in range(3):
        turns.filter(F.col("turn") % 3 == part).write.mode("append").parquet(source)
    schema = "conv_id bigint, turn bigint, role string, text string"
    lexicon = fx.table(spark, TURN_LEXICON, "word string, polarity int")
    totals, _ = running_polarity(
        spark, source, schema, lexicon, fresh_path(spark, "running"), "conv_id", files_per_batch=1
    )
    return totals.select("conv_id", "docs", "pos", "neg", "net")
