"""Vectors as arrays of numbers, on the JVM and in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(v: Column) -> Column:
    return v.cast("array<double>")


def _sum(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda a, x: a + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(doubles(a), doubles(b), lambda x, y: x * y))


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 less the cosine similarity; NaN if either is a zero vector."""
    size = norm(a) * norm(b)
    return F.when(size == 0, F.lit(float("nan"))).otherwise(1 - dot(a, b) / F.when(size != 0, size))


def l2_normalize(v: Column) -> Column:
    """v by its length; a zero vector becomes NaN in each place."""
    size = norm(v)
    return F.transform(doubles(v), lambda x: F.when(size == 0, F.lit(float("nan"))).otherwise(x / F.when(size != 0, size)))


def dimension(v: Column) -> Column:
    return F.size(v)


def sign_bits(v: Column, n: int = 64) -> Column:
    """A 64-bit signature: a bit for each of the first n numbers, set where it isn't negative."""
    return F.aggregate(F.transform(F.slice(v, 1, n), lambda x: F.when(x >= 0, F.lit(1)).otherwise(F.lit(0)).cast("long")), F.lit(0).cast("long"), lambda a, x: F.shiftleft(a, 1).bitwiseOR(x))
