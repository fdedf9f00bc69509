"""Vector arithmetic in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine similarity; null for a zero vector, a null element or vectors of different length."""
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when((norm > 0) & (F.size(a) == F.size(b)), F.lit(1.0) - dot(a, b) / norm)
