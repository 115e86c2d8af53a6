"""The query over near copies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prosewell.llm import simhash
from prosewell.plans.registry import query
from prosewell.sources.tables import read_table


@query("op6_simhash_near_dedup")
def simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's fingerprint and the smallest doc_id of its group."""
    return simhash.near_copies(read_table(spark, folder, "documents"))
