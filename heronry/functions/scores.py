"""Scores as Column expressions; sums run in a fixed order, in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

K1, B = 1.2, 0.75
RRF_K = 60


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """0 where either vector has no length."""
    na, nb = norm(a) if norm_a is None else norm_a, norm(b) if norm_b is None else norm_b
    return F.when((na == 0) | (nb == 0), F.lit(0.0)).otherwise(dot(a, b) / (na * nb))


def idf(n: Column, df: Column) -> Column:
    return F.ln((n - df + 0.5) / (df + 0.5) + 1)


def bm25_term(idf_: Column, tf: Column, length: Column, average: Column, times: Column) -> Column:
    saturated = tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / F.greatest(average, F.lit(1e-9))))
    return idf_ * saturated * times


def rrf(rank: Column) -> Column:
    """Share of a fused score for a rank that counts from 0."""
    return 1.0 / (RRF_K + rank + 1.0)


def recall_at(hits: Column, expected: Column, k: int) -> Column:
    """Share of ``expected`` among the first ``k`` hits; repeated entries count each time; 0 if nothing is expected."""
    found = F.filter(expected, lambda e: F.array_contains(F.slice(hits, 1, k), e))
    return F.when(F.size(expected) > 0, F.size(found) / F.greatest(F.size(expected), F.lit(1))).otherwise(F.lit(0.0))
