"""The training-data pipeline: documents in, token ids out.

Each stage is (spark, docs, sf_dir) -> DataFrame and works on all rows that the stage before kept. All but the last return
the columns of `documents`. Models are trained from `documents` and `labels` in `sf_dir`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosewell.llm import line_crf, mixing, piece_scan, simhash, site_quality
from prosewell.llm.common import stored
from prosewell.plans.registry import query
from prosewell.session import ship
from prosewell.sources.tables import read_table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, with what is known of their site, holds for good."""
    ship(spark)
    model = site_quality.train(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )
    return site_quality.keep_good(docs, model, F.col("source"), F.col("lang"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose lines are content enough."""
    ship(spark)
    model = line_crf.train(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )
    return line_crf.keep_good(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the smallest doc_id."""
    ship(spark)
    return simhash.one_of_each(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    ship(spark)
    return mixing.mix(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_ids, ids) of each row."""
    ship(spark)
    encoded = piece_scan.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_dedup),
    ("source_mix", source_mix),
    ("sentencepiece", sentencepiece),
]

# A trained classifier and field are no SQL.
ORACLE_SQL = None


@query("pipeline")
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read back before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
