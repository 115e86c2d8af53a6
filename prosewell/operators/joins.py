"""Lookup joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prosewell.sources.store import cut

BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
SLICES = 2_000
INLINE_VALUES = 20_000
MAX_LEVELS = 10_000


def names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _bytes(field: T.StructField) -> Column:
    """Size of one value, without building it anew where its type allows."""
    value, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, T.StringType):
        return F.octet_length(value)
    if isinstance(kind, T.NumericType):
        return F.lit(8)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
        return 8 * F.size(value)
    return F.octet_length(F.to_json(F.struct(value)))


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure `df`, rows and bytes of its values, against the broadcast bounds."""
    row = sum((F.coalesce(_bytes(f), F.lit(0)) for f in df.schema.fields), F.lit(0))
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(row), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def inline_values(df: DataFrame, limit: int = INLINE_VALUES) -> list | None:
    """The values of a one-column table, to be written into the plan; None beyond `limit`."""
    rows = df.distinct().limit(limit + 1).collect()
    return None if len(rows) > limit else sorted(r[0] for r in rows if r[0] is not None)


def lookup(
    big: DataFrame,
    small: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    rows_per_key: str | None = None,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join `big` with a look-up table.

    A table within the measured bounds is broadcast, and `big` does not move. A
    larger one goes through `sliced_join`. `rows_per_key` names a column of
    `small` that already holds the number of rows of `big` per key.
    """
    if fits_broadcast(small, max_rows):
        return big.join(F.broadcast(small), names(on), how)
    return sliced_join(big, small, on, how, rows_per_key)


def frequent_lookup(
    big: DataFrame,
    small: DataFrame,
    on: str | Sequence[str],
    level: Column,
    how: str = "inner",
    rows_per_key: str | None = None,
    max_rows: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """`lookup` for keys of very unlike frequency, such as words: inner or left.

    `level` is a whole number per row of `small`, of few different values, higher for keys that `big` has more often. Beyond the broadcast bounds the highest
    levels that are within them are broadcast, and only the rows of `big` with other keys are moved. No level is wrong: it decides what moves, not what is found.
    """
    max_rows, max_bytes = max_rows or BROADCAST_ROWS, max_bytes or BROADCAST_BYTES
    if fits_broadcast(small, max_rows, max_bytes):
        return big.join(F.broadcast(small), names(on), how)
    row = sum((F.coalesce(_bytes(f), F.lit(0)) for f in small.schema.fields), F.lit(0))
    levels = small.groupBy(level.try_cast("int").alias("v")).agg(F.count(F.lit(1)).alias("rows"), F.sum(row).alias("bytes"))
    lowest, rows, size = None, 0, 0
    for v, n, b in levels.filter("v is not null").orderBy(F.desc("v")).limit(MAX_LEVELS).collect():
        rows, size = rows + n, size + b
        if rows > max_rows or size > max_bytes:
            break
        lowest = v
    if lowest is None:
        return sliced_join(big, small, on, how, rows_per_key)
    often = F.coalesce(level.try_cast("int") >= lowest, F.lit(False))
    hot, rest = small.filter(often), small.filter(~often)
    seldom = big.join(F.broadcast(hot.select(*names(on))), names(on), "left_anti")
    if rows_per_key is None:
        # Few rows, which the sliced join counts before it moves them: `big` is not made again for that.
        seldom = cut(seldom)
    found = big.join(F.broadcast(hot), names(on), "inner")
    return found.unionByName(sliced_join(seldom, rest, on, how, rows_per_key))


def sliced_join(
    big: DataFrame,
    small: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    rows_per_key: str | None = None,
    slices: int = SLICES,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Shuffle join in which no key puts more than 1/`slices` of `big` into one task.

    Keys above that share are cut into as many slices as they need. Fewer than
    `slices` keys can be above it, whatever the data, so the table of hot keys
    is safe to broadcast and the copies made of `small` are few.
    The slice comes from a hash of the row: a retried task repeats it exactly. Rows without a
    key match nothing, so they are spread over all slices. `counts` (on, _rows) are given where the rows of `big` per key are known.
    """
    on = names(on)
    if counts is not None:
        pass
    elif rows_per_key is None:
        # Counted once: the share and the hot keys are read from what is stored, and `big` is not made again for them.
        counts = cut(big.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows")))
    else:
        counts = small.select(*on, F.col(rows_per_key).alias("_rows")).distinct()
    share = counts.agg((F.sum("_rows") / F.lit(slices)).alias("s")).scalar()
    hot = counts.filter(F.col("_rows") > share).select(
        *on, F.ceil(F.col("_rows") / share).cast("int").alias("_slices")
    )
    pieces = F.coalesce(F.col("_slices"), F.lit(1))
    no_key = reduce(or_, [F.col(c).isNull() for c in on])
    sliced_big = (
        big.withColumn("_hash", F.xxhash64(*big.columns))
        .join(F.broadcast(hot), on, "left")
        .withColumn("_slice", F.pmod("_hash", F.when(no_key, slices).otherwise(pieces)).cast("int"))
        .drop("_hash", "_slices")
    )
    sliced_small = (
        small.join(F.broadcast(hot), on, "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), pieces - 1)))
        .drop("_slices")
    )
    return sliced_big.join(sliced_small, [*on, "_slice"], how).drop("_slice")


def top_k(
    df: DataFrame, by: str | Sequence[str], order: Sequence, k: int, rank: str = "rank"
) -> DataFrame:
    """The first k rows of each group.

    Spark keeps only k rows per group and task before it shuffles them, so a hot
    group costs its final task k rows per input task, not the whole group.
    """
    window = Window.partitionBy(*names(by)).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)
