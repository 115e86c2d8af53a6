"""Lexicons in their published file layouts. None ships with the package; bring your own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_word_list(lines: DataFrame, polarity: int) -> DataFrame:
    """(word, polarity) of a one-word-per-line list in column `value`; `;` starts a comment line."""
    word = F.lower(F.trim(F.regexp_replace("value", "\r", "")))
    return (
        lines.select(word.alias("word"))
        .filter((F.col("word") != "") & ~F.col("word").startswith(";"))
        .select("word", F.lit(polarity).alias("polarity"))
        .dropDuplicates(["word", "polarity"])
    )


def merge_word_lists(positive: DataFrame, negative: DataFrame) -> DataFrame:
    """One row per word. A word on both lists has no single polarity and counts as 0."""
    both = parse_word_list(positive, 1).unionByName(parse_word_list(negative, -1))
    return both.groupBy("word").agg(F.sum("polarity").cast("int").alias("polarity"))


def read_opinion_lexicon(spark: SparkSession, positive_path: str, negative_path: str) -> DataFrame:
    return merge_word_lists(spark.read.text(positive_path), spark.read.text(negative_path))


def parse_sense_lexicon(lines: DataFrame) -> DataFrame:
    """(pos, synset_id, pos_score, neg_score, obj_score, terms, gloss), one row per synset.

    Tab-separated; `#` starts a comment line. Quotes and semicolons in glosses are plain text.
    """
    part = F.split(F.regexp_replace("value", "\r$", ""), "\t")
    return (
        lines.filter(~F.col("value").startswith("#") & F.col("value").contains("\t"))
        .select(
            F.trim(F.get(part, F.lit(0))).alias("pos"),
            F.trim(F.get(part, F.lit(1))).alias("synset_id"),
            F.get(part, F.lit(2)).try_cast("double").alias("pos_score"),
            F.get(part, F.lit(3)).try_cast("double").alias("neg_score"),
            F.trim(F.get(part, F.lit(4))).alias("terms"),
            F.coalesce(F.get(part, F.lit(5)), F.lit("")).alias("gloss"),
        )
        .filter("pos_score is not null and neg_score is not null")
        .withColumn("obj_score", 1 - F.col("pos_score") - F.col("neg_score"))
    )


def read_sense_lexicon(spark: SparkSession, path: str) -> DataFrame:
    return parse_sense_lexicon(spark.read.text(path))
