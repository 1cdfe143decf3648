"""Vector math on ``array<float>`` columns with higher-order functions
(JVM-side; no Python).  Spark 4.1 has no vector type or distance builtin."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _lit_vec(v) -> Column:
    if isinstance(v, Column):
        return v
    return F.array(*[F.lit(float(x)) for x in v])


def dot(a, b) -> Column:
    prods = F.zip_with(_c(a), _lit_vec(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_distance(a, b) -> Column:
    """Euclidean distance; NULL when either side is NULL."""
    diffs = F.zip_with(_c(a), _lit_vec(b), lambda x, y: x.cast("double") - y.cast("double"))
    return F.sqrt(F.aggregate(diffs, F.lit(0.0), lambda acc, x: acc + x * x))


def cosine_similarity(a, b) -> Column:
    """dot / (|a| |b|); NULL for a zero vector (never a division error)."""
    denom = norm(a) * norm(_lit_vec(b))
    return dot(a, b) / F.nullif(denom, F.lit(0.0))


def has_dim(a, dim: int) -> Column:
    """The fixed-width check Spark lacks a type for."""
    return F.size(_c(a)) == dim
