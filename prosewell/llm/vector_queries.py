"""The query over nearest vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prosewell.llm import vector_scan
from prosewell.plans.registry import query
from prosewell.sources.tables import read_table


@query("op3_adaptive_scan")
def adaptive_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The ten nearest vectors of every hundredth."""
    return vector_scan.nearest(read_table(spark, folder, "embeddings"))
