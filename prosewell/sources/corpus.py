"""Folders of plain-text messages in, compact parquet out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_corpus(spark: SparkSession, root: str, partitions: bool = False) -> DataFrame:
    """(grp, msg_no, raw), one row per file `<root>/<grp>/<msg_no>`.

    With `partitions`, the layout of `write_files`: `<root>/grp=<grp>/msg_no=<msg_no>/<any file>`.
    Thousands of tiny files cost far more to open than to read: read them once, then
    `write_corpus` and work from the compact copy.
    """
    # Spark writes some signs of a path as %XX; a `+` in it is a plus and no blank.
    parts = F.split(F.regexp_replace(F.input_file_name(), r"\+", "%2B"), "/")
    last = -2 if partitions else -1

    def part(i: int) -> Column:
        value = F.url_decode(F.element_at(parts, i))
        return F.url_decode(F.regexp_replace(F.substr(value, F.instr(value, "=") + 1), r"\+", "%2B")) if partitions else value

    return (
        spark.read.text(root, wholetext=True, recursiveFileLookup=True)
        .select(
            part(last - 1).alias("grp"),
            part(last).try_cast("bigint").alias("msg_no"),
            F.col("value").alias("raw"),
        )
        .filter("msg_no is not null")
    )


# What ends a record of a bundle, and what stands for it and for itself inside one.
RECORD_END, ESCAPE = "\x1e", "\x1f"


def write_bundles(df: DataFrame, root: str, rows_per_file: int = 100_000) -> None:
    """(grp, msg_no, raw) as text files of many messages, in a folder per group: a record is the number, a newline and the message.

    The number of files follows the rows, not the messages. A message may hold any character: the record's end is escaped in it.
    """
    raw = F.replace(F.replace("raw", F.lit(ESCAPE), F.lit(ESCAPE + "1")), F.lit(RECORD_END), F.lit(ESCAPE + "0"))
    records = df.select(F.concat_ws("\n", F.col("msg_no").cast("string"), raw).alias("value"), "grp")
    (
        records.hint("rebalance", "grp")
        .write.partitionBy("grp")
        .option("lineSep", RECORD_END)
        .option("maxRecordsPerFile", rows_per_file)
        .text(root)
    )


def read_bundles(spark: SparkSession, root: str) -> DataFrame:
    """(grp, msg_no, raw) of the files of `write_bundles`. Files are split only between records; groups are text whatever they look like."""
    records = spark.read.schema("value string, grp string").option("lineSep", RECORD_END).text(root)
    number, raw = F.substring_index("value", "\n", 1), F.expr("substr(value, instr(value, '\n') + 1)")
    raw = F.replace(F.replace(raw, F.lit(ESCAPE + "0"), F.lit(RECORD_END)), F.lit(ESCAPE + "1"), F.lit(ESCAPE))
    return records.select("grp", number.try_cast("bigint").alias("msg_no"), raw.alias("raw"))


def write_files(df: DataFrame, root: str) -> None:
    """One text file per row of (grp, msg_no, raw), ended by a newline, for tools that read messages as files."""
    df.select("grp", "msg_no", "raw").write.partitionBy("grp", "msg_no").text(root)


def write_corpus(
    df: DataFrame, path: str, partition_by: str | None = None, mode: str = "errorifexists"
) -> None:
    """Write as parquet; `partition_by` lets later reads skip whole folders.

    Rows are rebalanced by the partition column so that each folder gets few large files. A
    group too large for one file is split by the rebalance, not sent to a single task.
    """
    if partition_by is None:
        df.hint("rebalance").write.mode(mode).parquet(path)
    else:
        df.hint("rebalance", partition_by).write.mode(mode).partitionBy(partition_by).parquet(path)
