"""Vector expressions over array<double> (or float) columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Dot product in double; null when the lengths differ or an element is null."""
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0),
        lambda total, x: total + x,
    )


def norm(a: Column) -> Column:
    """Euclidean length in double; null when an element is null."""
    squares = F.aggregate(
        a, F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )
    return F.sqrt(squares)


def cosine(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """Cosine similarity; null for a zero vector or different lengths.

    A length that is known already can be passed in and is then not computed per row.
    """
    lengths = (norm(a) if norm_a is None else norm_a) * (norm(b) if norm_b is None else norm_b)
    return dot(a, b) / F.nullif(lengths, F.lit(0.0))


def cls_pool(hidden: Column) -> Column:
    """First token's vector of a tokens x dims array; null when there is no token."""
    return F.get(hidden, F.lit(0))


def reshape(vector: Column, rows: int, columns: int) -> Column:
    """Flat vector to a rows x columns array of arrays."""
    return F.array(*[F.slice(vector, r * columns + 1, columns) for r in range(rows)])


def multiply(a: Column, b: Column) -> Column:
    return a * b
