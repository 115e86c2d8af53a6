"""The query over SentencePiece ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosewell.llm import piece_scan
from prosewell.plans.registry import query
from prosewell.sources.tables import read_table


@query("op10_sentencepiece_scan")
def sentencepiece_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's ids, and size and digest of the text that they give back."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = piece_scan.encode_documents(read_table(spark, folder, "documents"), model)
    return piece_scan.decode_documents(encoded, model).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        "ids",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("text_sha256"),
    )
