"""The query over periodic runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prosewell.functions.text import let
from prosewell.llm import periodic_runs
from prosewell.llm.common import text_of
from prosewell.plans.registry import query
from prosewell.sources.tables import read_table

SEPARATORS = r"[\x20\x09-\x0D]+"


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the documents, by a checksum of the id, repeat some of their words to the end."""
    checksum = F.crc32(F.col("doc_id").cast("string"))
    tenth = F.floor(checksum / F.lit(10))

    def repeated(words: Column) -> Column:
        n = F.size(words)
        first = F.pmod(tenth, n).cast("int")
        period = F.lit(1) + F.floor((n - first) / (F.lit(3) + tenth % 8)).cast("int")
        at = F.transform(
            F.sequence(F.lit(0), n - 1),
            lambda i: F.when(i < first, i).otherwise(first + F.pmod(i - first, period)),
        )
        return F.when(
            n > 0, F.array_join(F.transform(at, lambda i: F.get(words, i)), " ")
        ).otherwise("")

    words = F.filter(F.split(text_of(), SEPARATORS), lambda w: w != "")
    return docs.select(
        "doc_id",
        F.when(checksum % 10 == 0, let(words, repeated)).otherwise(text_of()).alias("text"),
    )


def strongest(runs: Column) -> Column:
    """The run of the greatest length by period; of equal ones the first."""
    kind = "struct<start:bigint,length:bigint,period:bigint>"
    return F.reduce(
        runs,
        F.lit(None).cast(kind),
        lambda best, run: F.when(
            best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"]), run
        ).otherwise(best),
    )


@query("op12_periodic_runs")
def periodic(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's runs and what is left of its text without their repetitions."""
    docs = with_planted_runs(read_table(spark, folder, "documents"))
    found = periodic_runs.collapse_runs(docs, min_length=6, min_exponent=4)
    lines = F.transform(
        "runs",
        lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))),
    )
    return found.withColumn("best", strongest(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda s: F.concat(s, F.lit("\n"))), ""), 256).alias(
            "runs_sha256"
        ),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
