"""Column functions on array<double> vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """0 where a vector has no length; unlike dimensions fail."""
    n = norm(a) * norm(b)
    fine = F.when(F.size(a) == F.size(b), F.lit(True)).otherwise(F.raise_error(F.lit("vectors of unlike dimension")).cast("boolean"))
    return F.when(fine & (n > 0), dot(a, b) / n).otherwise(F.lit(0.0))


def normalise(a: Column) -> Column:
    """Unit length; a zero vector stays."""
    n = norm(a)
    return F.when(n > 0, F.transform(a, lambda x: x / n)).otherwise(a)
