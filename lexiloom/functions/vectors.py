"""Vector functions on arrays of numbers, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of the angle; a missing vector, or one of no length, gives -1."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(-1.0))


def unit(a: Column | str) -> Column:
    """The vector at length 1; null if it has none."""
    length = norm(a)
    return F.when(length > 0, F.transform(_col(a), lambda x: x.cast("double") / length))


def weighted_sum(vectors: Column, weights: Column, size: int) -> Column:
    """The sum of weighted unit vectors at length 1; ``vectors`` is an array of arrays."""
    zero = F.array_repeat(F.lit(0.0), size)
    pairs = F.zip_with(vectors, weights, lambda v, w: F.transform(unit(v), lambda x: x * w))
    return unit(F.aggregate(pairs, zero, lambda s, v: F.zip_with(s, v, lambda x, y: x + y)))
