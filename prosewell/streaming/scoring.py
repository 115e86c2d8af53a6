"""Opinion scores for documents as they arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prosewell.functions import text as T
from prosewell.operators import opinion
from prosewell.operators.joins import fits_broadcast, names
from prosewell.streaming.files import arriving, landed, run_to_sink

# What tells the rows of a stream apart: documents that share a key keep a row each.
PLACE = ["_file", "_row"]


def partial_counts(stream: DataFrame, lexicon: DataFrame, col: str, keys: Sequence[str]) -> DataFrame:
    """(keys, _file, _row, tokens, pos, neg, _whole) in parts that add up to a document's counts. No state, no aggregate.

    A lexicon of a few thousand words becomes sets in the plan, and a document is one part. A larger one is joined: a static
    table that is broadcast if its measured size allows it, else shuffled; then a document has a part for all of its tokens and
    one for each distinct word of it that the lexicon lists. `_whole` marks one part of each document.
    """
    placed = stream.select(
        *(F.col(f"`{k}`") for k in keys),
        F.col(f"`{col}`").alias("_text"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    if opinion.inline_words(lexicon) is not None:
        whole = opinion.count_polarity(placed, lexicon, "_text", [*keys, *PLACE])
        return whole.drop("net").withColumn("_whole", F.lit(True))
    words = F.coalesce(T.words("_text"), F.array().cast("array<string>"))
    whole = F.array(F.struct(F.lit(None).cast("string").alias("token"), F.size("_words").cast("bigint").alias("tf")))
    parts = placed.withColumn("_words", words).select(
        *(F.col(f"`{k}`") for k in keys), *PLACE, F.inline(F.concat(whole, T.counted_terms(F.col("_words"))))
    )
    signs = opinion.lexicon_signs(lexicon)
    signs = F.broadcast(signs) if fits_broadcast(signs) else signs
    found = parts.join(signs, "token", "left").filter(F.col("token").isNull() | F.col("_pos").isNotNull())

    def counted(sign: str) -> Column:
        return F.when(F.col("token").isNotNull(), F.col("tf") * F.col(sign)).otherwise(0)

    return found.select(
        *(F.col(f"`{k}`") for k in keys),
        *PLACE,
        F.when(F.col("token").isNull(), F.col("tf")).otherwise(0).alias("tokens"),
        counted("_pos").alias("pos"),
        counted("_neg").alias("neg"),
        F.col("token").isNull().alias("_whole"),
    )


def score_stream(
    spark: SparkSession,
    source: str,
    schema: str,
    lexicon: DataFrame,
    target: str,
    col: str = "text",
    key: str | Sequence[str] = "doc_id",
    files_per_batch: int = 1000,
) -> DataFrame:
    """Score every file that has arrived under `source`, and return all scores so far: an empty table before the first.

    A document arrives whole. Call again with the same `target` to go on from where the last call stopped; a batch killed midway is
    neither doubled nor lost (see `files`). Documents that share a key, or have none, keep a row each, and null texts count 0.
    """
    keys = names(key)
    schema = spark.createDataFrame([], schema).schema
    # The same expressions over an empty batch tell the schema of what the sink holds.
    nothing = spark.createDataFrame([], schema).select(
        "*", F.struct(F.lit("").alias("file_path"), F.lit(0).cast("bigint").alias("row_index")).alias("_metadata")
    )
    held = partial_counts(nothing, lexicon, col, keys).schema
    stream = arriving(spark, source, schema, files_per_batch)
    if stream is not None:
        run_to_sink(partial_counts(stream, lexicon, col, keys), target)
    parts = landed(spark, target, held)
    if opinion.inline_words(lexicon) is None:
        sums = [F.sum(c).alias(c) for c in ("tokens", "pos", "neg")]
        parts = parts.groupBy(*keys, *PLACE).agg(*sums)
    scores = parts.drop(*PLACE, "_whole").withColumn("net", F.col("pos") - F.col("neg"))
    return opinion.classify_polarity(scores)
