"""Arithmetic on ``array<double>`` columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(values: Column) -> Column:
    """Sum of an array of doubles, left to right."""
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return total(F.zip_with(a, b, lambda x, y: x * y))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(total(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))


def scale(vector: Column, weight: Column) -> Column:
    return F.transform(vector, lambda x: x * weight)


def mean_vector(vectors: Column) -> Column:
    """Position-wise mean of an array of equally long vectors."""
    zero = F.transform(F.element_at(vectors, 1), lambda x: x * 0.0)
    summed = F.aggregate(vectors, zero, lambda acc, v: F.zip_with(acc, v, lambda x, y: x + y))
    return F.transform(summed, lambda x: x / F.size(vectors))


def pad(values: Column, size: int) -> Column:
    """``values`` filled up with 0.0 to ``size`` entries; null counts as empty."""
    filled = F.coalesce(values, F.array().cast("array<double>"))
    return F.slice(F.concat(filled, F.array_repeat(F.lit(0.0), size)), 1, size)


def mean_of_slice(values: Column, start: int, length: int) -> Column:
    """Mean of ``length`` entries from the 1-based position ``start``."""
    return total(F.slice(values, start, length)) / F.lit(float(length))


def literal(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(v)) for v in values])
