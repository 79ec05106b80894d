"""Column expressions over ``array<float>`` / ``array<double>`` vectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(as_double(a), F.lit(0.0), lambda s, x: s + x * x))


def l2_normalise(a: Column) -> Column:
    """Unit-length vector; null for the zero vector."""
    length = norm(a)
    return F.when(length > 0, F.transform(as_double(a), lambda x: x / length))


def cosine(a: Column, b: Column, digits: int = 6) -> Column:
    """Cosine similarity of two columns of one row, rounded; null when a side is zero."""
    return F.round(F.try_divide(dot(a, b), norm(a) * norm(b)), digits)


def scale_by(a: Column, divisor: float = 255.0) -> Column:
    return F.transform(as_double(a), lambda x: x / divisor)


def standardise(a: Column, mean: float = 0.1307, deviation: float = 0.3081) -> Column:
    return F.transform(as_double(a), lambda x: (x - mean) / deviation)


def arg_max(a: Column) -> Column:
    """Zero-based position of the first largest element."""
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")
