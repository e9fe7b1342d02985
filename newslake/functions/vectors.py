"""Vector expressions that stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Dot product of two arrays, summed in double precision."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0.0 where either vector is zero."""
    size = norm(a) * norm(b)
    return F.when(size > 0, dot(a, b) / size).otherwise(F.lit(0.0))


def has_dimension(vector: Column, dimension: int) -> Column:
    """True when the vector is present and has the declared size."""
    return F.coalesce(F.size(vector) == dimension, F.lit(False))


def as_text(vector: Column, digits: int = 6) -> Column:
    """Components as fixed-point text, for reports and comparison."""
    return F.array_join(
        F.transform(vector, lambda x: F.format_string(f"%.{digits}f", x.cast("double"))), ","
    )
