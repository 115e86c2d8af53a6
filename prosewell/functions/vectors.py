"""Column expressions over array<double> vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from prosewell.functions.text import let


def dot(a: Column | str, b: Column | str) -> Column:
    a, b = F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column | str) -> Column:
    a = F.col(a) if isinstance(a, str) else a
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda s, x: s + x * x))


def scaled(a: Column | str, by: Column) -> Column:
    """Divide by `by`; null where it is 0."""
    a = F.col(a) if isinstance(a, str) else a
    return let(by, lambda n: F.when(n != 0, F.transform(a, lambda x: x / n)))


def unit(a: Column | str) -> Column:
    return scaled(a, norm(a))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Similarity of two vectors; null when either has length 0."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))
