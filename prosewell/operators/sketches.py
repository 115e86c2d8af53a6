"""Profiles that merge: sketches of groups of documents, stored as columns.

A day's files are profiled once. Profiles of many days add up without reading any text again: counts are summed, sketches of sizes, words and
texts are merged. Each holds a bounded number of values whatever it has seen, so what is stored and shuffled is one small row per group and task.

Sizes are a KLL sketch: a quantile's rank is off by less than `RANK_ERROR` of the rows. Distinct words are a theta sketch, which also tells unions,
intersections and differences; distinct texts are an HLL sketch. Their relative errors are near `1 / sqrt(2**LOG_ENTRIES)` and `1.04 / sqrt(2**LOG_CELLS)`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosewell.functions import text as T
from prosewell.operators.joins import names

KLL_SIZE = 400
RANK_ERROR = 0.012
LOG_ENTRIES = 14
LOG_CELLS = 14

SUMS = ["docs", "tokens", "bytes", "blank"]
SKETCHES = ["sizes", "words", "texts"]


def sketch_profile(docs: DataFrame, by: str | Sequence[str], col: str = "text") -> DataFrame:
    """(by, docs, tokens, bytes, blank, sizes, words, texts): sums and sketches of each group.

    A null text has no bytes and no words, and is no text. Words reach the sketch as distinct ones of each document. Null keys are a group; an empty table gives none.
    """
    by = names(by)
    words = F.coalesce(T.words(col), F.array().cast("array<string>"))
    rows = docs.select(
        *(F.col(f"`{c}`") for c in by),
        words.alias("_words"),
        F.octet_length(F.coalesce(F.col(f"`{col}`"), F.lit(""))).cast("bigint").alias("_bytes"),
        F.when(F.col(f"`{col}`").isNotNull(), F.md5(T.folded(F.col(f"`{col}`")))).alias("_digest"),
    )
    # One row per document and distinct word; the first carries what is counted once per document.
    parts = rows.select(
        *by, "_bytes", "_digest", F.size("_words").alias("_n"), F.posexplode_outer(F.array_distinct("_words")).alias("_i", "_word")
    )
    first = F.coalesce(F.col("_i") == 0, F.lit(True))

    def once(value: Column) -> Column:
        return F.when(first, value)

    return parts.groupBy(*by).agg(
        F.count(once(F.lit(1))).alias("docs"),
        F.coalesce(F.sum(once(F.col("_n"))), F.lit(0)).cast("bigint").alias("tokens"),
        F.coalesce(F.sum(once(F.col("_bytes"))), F.lit(0)).alias("bytes"),
        F.count_if(first & (F.col("_n") == 0)).alias("blank"),
        F.kll_sketch_agg_bigint(once(F.col("_bytes")), F.lit(KLL_SIZE)).alias("sizes"),
        F.theta_sketch_agg("_word", F.lit(LOG_ENTRIES)).alias("words"),
        F.hll_sketch_agg(once(F.col("_digest")), F.lit(LOG_CELLS)).alias("texts"),
    )


def merge_profiles(profiles: DataFrame, by: str | Sequence[str] = ()) -> DataFrame:
    """Profiles of the same `by` as one row; of all of them without `by`. The rows that go in may be of any days, files or groups."""
    by = names(by)
    return profiles.groupBy(*by).agg(
        *(F.sum(c).alias(c) for c in SUMS),
        F.kll_merge_agg_bigint("sizes").alias("sizes"),
        F.theta_union_agg("words", F.lit(LOG_ENTRIES)).alias("words"),
        F.hll_union_agg("texts").alias("texts"),
    )


def read_profile(profiles: DataFrame, quantiles: Sequence[float] = (0.0, 0.5, 0.99, 1.0)) -> DataFrame:
    """The profiles' sums, with `size_quantiles array<bigint>`, `distinct_words` and `distinct_texts` in place of the sketches."""
    kept = [c for c in profiles.columns if c not in SKETCHES]
    at = F.array(*[F.lit(float(q)) for q in quantiles])
    return profiles.select(
        *(F.col(f"`{c}`") for c in kept),
        F.when(F.col("docs") > 0, F.kll_sketch_get_quantile_bigint("sizes", at)).alias("size_quantiles"),
        F.theta_sketch_estimate("words").alias("distinct_words"),
        F.hll_sketch_estimate("texts").alias("distinct_texts"),
    )


def sketched_overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """(both, only_a, only_b, jaccard) of the words of two one-row profiles, estimated from their sketches alone."""
    pair = a.select(F.lit(1).alias("_one"), F.col("words").alias("_a")).join(
        b.select(F.lit(1).alias("_one"), F.col("words").alias("_b")), "_one"
    )
    estimate = F.theta_sketch_estimate
    counts = pair.select(
        estimate(F.theta_intersection("_a", "_b")).alias("both"),
        estimate(F.theta_difference("_a", "_b")).alias("only_a"),
        estimate(F.theta_difference("_b", "_a")).alias("only_b"),
    )
    return counts.withColumn("jaccard", F.try_divide(F.col("both"), F.col("both") + F.col("only_a") + F.col("only_b")))
