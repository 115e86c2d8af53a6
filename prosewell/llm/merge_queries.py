"""The query over byte-level merges."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosewell.llm import merge_tree
from prosewell.plans.registry import query
from prosewell.sources.tables import read_table


@query("op13_merge_tree")
def merge_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Number and digest of every document's ids, and digest of the bytes that they give back."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = read_table(spark, folder, "documents")
    encoded = merge_tree.encode_documents(docs, ranks, public_tokenizers.PATTERN)
    return merge_tree.decode_documents(encoded, ranks).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
