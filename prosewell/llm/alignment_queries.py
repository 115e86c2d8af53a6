"""The query over the alignment of two tokenizers."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosewell.llm import alignment
from prosewell.llm.common import stored
from prosewell.plans.registry import query
from prosewell.sources.tables import read_table


@query("op11_fragment_alignment")
def fragment_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's groups and links, and how usual its links are in all documents."""
    found = alignment.align_documents(
        read_table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    aligned = stored(found.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    return alignment.score_links(aligned, alignment.linked_pairs(aligned))
