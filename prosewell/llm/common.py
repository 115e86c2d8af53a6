"""Helpers the operators of this folder share."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosewell.sources.store import fresh_path

# Fixed value: a word is a run of anything but blank, tab, newline, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD)
# Lower-cases A to Z and leaves every other byte.
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
BATCH_ROWS = 2_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` to the shared folder and read it back: lineage is cut, a lost executor loses nothing."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def fraction(parts: int, *columns: Column) -> Column:
    """A number from 0 to `parts` - 1 from a hash of the columns: the same on every run and every retry."""
    return F.pmod(F.xxhash64(F.lit(71), *columns), F.lit(parts))


def sampled(df: DataFrame, key: Sequence[Column], rows: int, total: int) -> DataFrame:
    """About `rows` of the `total` rows, chosen by a hash of `key`; all of them if there are no more."""
    if total <= rows:
        return df
    parts = 1 << 30
    return df.filter(fraction(parts, *key) < F.lit(int(parts * rows / total)))


def sliced(batch: pa.RecordBatch, rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """A batch in pieces, so that a step's own lists stay small."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def sliced_by_bytes(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about `most` bytes of a text column; a longer text is a piece by itself."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def ascii_words(text: str) -> list[bytes]:
    """The words of `text` as UTF-8; bytes.split() parts at exactly the six separators of WORD."""
    return text.encode("utf-8", "surrogatepass").split()
