"""Queries over the quality of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosewell.llm import line_crf, site_quality
from prosewell.llm.common import stored
from prosewell.plans.registry import query
from prosewell.sources.tables import read_table


@query("op8_line_crf")
def line_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts of every document and whether its lines are content enough."""
    docs = read_table(spark, folder, "documents")
    return line_crf.verdicts(docs, line_crf.train(docs, read_table(spark, folder, "labels")))


@query("op9_site_quality")
def site_quality_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's text score, its host's and path's posterior, and whether it is kept. The source is the host, source and language the path."""
    docs = read_table(spark, folder, "documents")
    model = site_quality.train(docs, read_table(spark, folder, "labels"))
    scored = docs.select(
        "doc_id",
        F.col("source").alias("host"),
        F.col("lang").alias("path"),
        site_quality.evidence(F.col("text"), model).alias("_evidence"),
    )
    scored = stored(scored, "evidence")
    return site_quality.combined(scored, site_quality.site_posteriors(scored)).drop("_evidence")
