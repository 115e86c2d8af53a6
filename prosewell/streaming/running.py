"""Running polarity per conversation: keyed state that outlives the stream's runs.

The state of a conversation is four counts and the time of its first turn. Every batch adds the turns that arrived and writes the new
counts of the conversations it touched, so the sink holds their history; a version number tells the latest. State that is idle for
longer than a documented time is dropped; a later turn begins a new episode, and the episodes of a conversation add up.

A conversation may hold any share of the turns: its turns are dealt over a few slices by a hash of their place in the input, each with
counts of its own, and slices add up like episodes. Turns are counted inside the JVM; only small numbers go to the state.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from prosewell.operators import opinion
from prosewell.operators.joins import names
from prosewell.streaming.files import arriving, landed, run_to_sink
from prosewell.streaming.scoring import partial_counts

COUNTS = ["docs", "tokens", "pos", "neg"]
# Keyed state lives in the RocksDB store. A run ends when all files are read: without new files no batch is made to look at timers.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


class RunningCounts(StatefulProcessor):
    """Adds up the counts of a key; forgets a key that has been idle for `idle_ms`."""

    def __init__(self, idle_ms: int) -> None:
        self._idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        fields = ", ".join(f"{c} long" for c in [*COUNTS, "since", "version", "last"])
        self._state = handle.getValueState("counts", fields)

    def _row(self, key: tuple, state: Sequence[int], expired: bool) -> pd.DataFrame:
        columns = ["_key", "_slice", *COUNTS, "since", "version", "expired"]
        return pd.DataFrame([[*key, *state, expired]], columns=columns)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs()
        held = self._state.get()
        state = list(held) if held is not None else [0] * len(COUNTS) + [now, 0, now]
        for batch in rows:
            for i, c in enumerate(COUNTS):
                state[i] += int(batch[c].sum())
        state[-2:] = state[-2] + 1, now
        self._state.update(tuple(state))
        # Each call of the store is a round trip: a key has one timer, and it is looked at only when it fires.
        if held is None:
            self._handle.registerTimer(now + self._idle_ms)
        yield self._row(key, state[:-1], False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        state = list(self._state.get())
        due = state[-1] + self._idle_ms
        if timerValues.getCurrentProcessingTimeInMs() < due:
            self._handle.registerTimer(due)
            return
        self._state.clear()
        state[-2] += 1
        yield self._row(key, state[:-1], True)

    def close(self) -> None:
        pass


def running_polarity(
    spark: SparkSession,
    source: str,
    schema: str,
    lexicon: DataFrame,
    target: str,
    by: str | Sequence[str],
    col: str = "text",
    idle_ms: int = 7 * 24 * 3_600_000,
    slices: int = 4,
    files_per_batch: int = 1000,
) -> tuple[DataFrame, DataFrame]:
    """(totals, history) of all files that have arrived under `source`.

    totals: (by, docs, pos, neg, net, tokens, class, episodes), a row per key, equal to the batch form over the same files. history: what every batch wrote, (by, _slice,
    counts, since, version, expired); `expired` rows are the last of their episode, written by the first batch that runs `idle_ms` milliseconds or more after the
    key's last one. Call again with the same `target` to go on; nothing arrived gives empty tables. Null keys are a key, null texts count 0 tokens.
    """
    by = names(by)
    kind = spark.createDataFrame([], schema).schema
    fields = ["_key string", "_slice int", *(f"{c} long" for c in [*COUNTS, "since", "version"]), "expired boolean"]
    held = spark.createDataFrame([], ", ".join(fields)).schema
    stream = arriving(spark, source, schema, files_per_batch)
    if stream is not None:
        parts = partial_counts(stream, lexicon, col, by)
        turns = parts.withColumn("docs", F.col("_whole").cast("long")).withColumn(
            "_slice", F.pmod(F.xxhash64("_file", "_row"), F.lit(slices)).cast("int")
        )
        counted = (
            turns.select(F.to_json(F.struct(*by)).alias("_key"), "_slice", *COUNTS)
            .groupBy("_key", "_slice")
            .transformWithStateInPandas(RunningCounts(idle_ms), held, "Append", "ProcessingTime")
        )
        run_to_sink(counted, target, SETTINGS)
    # Keys travel as text: a null among whole numbers would turn a worker's keys into floats.
    schema = ", ".join(f"`{k}` {kind[k].dataType.simpleString()}" for k in by)
    history = landed(spark, target, held).withColumn("_key", F.from_json("_key", schema))
    history = history.select("_key.*", *history.columns[1:])
    latest = history.groupBy(*by, "_slice", "since").agg(
        *(F.max_by(c, "version").alias(c) for c in COUNTS)
    )
    totals = latest.groupBy(*by).agg(
        *(F.sum(c).alias(c) for c in COUNTS), F.count_distinct("since").alias("episodes")
    )
    return opinion.classify_polarity(totals.withColumn("net", F.col("pos") - F.col("neg"))), history
