"""Vector functions as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine in -1..1; null for zero, non-finite or differently long vectors."""
    d = dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))
    return F.when((F.size(a) == F.size(b)) & (dot(a, a) > 0) & (dot(b, b) > 0) & ~F.isnan(d), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), d)))


def bucket(length: str | Column, low: float, high: float, n: int) -> Column:
    """Index of the equal-width bucket (low, .. high], closed above; null outside [low, high]."""
    x = F.col(length) if isinstance(length, str) else length
    edges = [low + (high - low) * k / n for k in range(1, n)]
    at = F.lit(0)
    for e in edges:
        at = at + (x > e).cast("int")
    return F.when((x >= low) & (x <= high), at)


def time_steps(n: int, shift: float) -> Column:
    """n + 1 steps from 0 to 1, bent by shift: s t / (1 + (s - 1) t)."""
    return F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: shift * (i / n) / (1 + (shift - 1) * (i / n)))
