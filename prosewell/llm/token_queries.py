"""Queries over token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from prosewell.llm import token_blocks
from prosewell.plans.registry import query
from prosewell.sources.store import fresh_path
from prosewell.sources.tables import read_table


@query("op1_token_blocks")
def token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids, written as blocks and read back."""
    docs = read_table(spark, folder, "documents")
    path = fresh_path(spark, "token-blocks")
    token_blocks.write_token_files(docs, path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_blocks.read_token_files(spark, path)
