"""Small tables with the cases that every operator must take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size long, row string, `key` string, "
    "fp long, host string, path string, score double, turn long, copies int, name string, part int"
)
CLASHES = (9, "r", "k", 9, "h", "p", 0.5, 9, 9, "n", 9)


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Documents of (doc_id, text, lang, source), with extra columns named as operators name their own."""
    full = [(*r, len(r[1] or ""), *CLASHES) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


ODD = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \n\t ", "en", "a"),
    (None, "no id here at all but some words", None, "a"),
    (4, "one", "en", None),
    (5, "the same words in every copy of this text here now", "en", "a"),
    (5, "the same words in every copy of this text here now", "en", "a"),
    (6, "The same words in every copy of this text here now", "en", "b"),
    (7, "blank  blank\r\n\x0bodd spaces ▁ ﷐ 你好 é́ <|endoftext|> </s>[INST]", "fr", "b"),
    (8, "word " * 30_000, "en", "b"),
    (9, "x" * 70_000, "en", "b"),
]
