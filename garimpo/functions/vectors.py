"""Vector arithmetic on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(v: Column) -> Column:
    return F.sqrt(_dot(v, v))


def cosine_similarity(a: Column, b: Column) -> Column:
    """1 - cosine distance; null for a zero vector or vectors of different length."""
    return cosine_of(a, b, norm(a), norm(b))


def cosine_of(a: Column, b: Column, norm_a: Column, norm_b: Column) -> Column:
    """``cosine_similarity`` where the norms are known."""
    scale = norm_a * norm_b
    return F.when((F.size(a) == F.size(b)) & (scale != 0), F.try_divide(_dot(a, b), scale))
