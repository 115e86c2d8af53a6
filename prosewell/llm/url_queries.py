"""The query over URLs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosewell.llm import url_models
from prosewell.plans.registry import query
from prosewell.sources.tables import read_table

# The rules of the query.
ALLOW = ["org/", "com/fr/"]
BLOCK = ["example.org/es/", "example.org/en/1", "com/de/"]


@query("op7_url_models")
def url_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    pages = read_table(spark, folder, "pages").select(F.col("page_id").alias("key"), "url")
    return url_models.judged(pages, ALLOW, BLOCK).withColumnRenamed("key", "page_id")
