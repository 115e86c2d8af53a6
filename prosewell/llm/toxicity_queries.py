"""The query over toxicity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prosewell.llm import toxicity
from prosewell.plans.registry import query
from prosewell.sources.tables import read_table


@query("op5_pu_toxicity")
def pu_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's toxicity."""
    docs = read_table(spark, folder, "documents")
    return toxicity.scores(docs, toxicity.train(docs, read_table(spark, folder, "labels")))
