"""Column expressions used by scoring and metrics (all JVM-side, inside codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sigmoid(x: str | Column) -> Column:
    return 1.0 / (1.0 + F.exp(-col(x)))


def dot(a: str | Column, b: str | Column) -> Column:
    """Inner product of two equally long double arrays."""
    return F.aggregate(F.zip_with(col(a), col(b), lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def weighted_dot(a: str | Column, b: str | Column, w: list[float]) -> Column:
    """sum_j w_j * a_j * b_j with a literal weight vector."""
    wv = F.array(*[F.lit(float(x)) for x in w])
    prod = F.zip_with(F.zip_with(col(a), col(b), lambda x, y: x * y), wv, lambda x, y: x * y)
    return F.aggregate(prod, F.lit(0.0), lambda acc, v: acc + v)


def mf_logit(user_factors: str | Column, item_factors: str | Column, user_bias: str | Column,
             item_bias: str | Column, global_bias: float = 0.0) -> Column:
    return F.lit(float(global_bias)) + col(user_bias) + col(item_bias) + dot(user_factors, item_factors)


def mf_score(user_factors, item_factors, user_bias, item_bias, global_bias: float = 0.0) -> Column:
    """sigmoid(mu + b_u + b_i + p . q)."""
    return sigmoid(mf_logit(user_factors, item_factors, user_bias, item_bias, global_bias))


def gmf_score(user_factors, item_factors, weights: list[float], bias: float = 0.0) -> Column:
    """sigmoid(w . (p * q) + b)."""
    return sigmoid(weighted_dot(user_factors, item_factors, weights) + F.lit(float(bias)))


def discount(rank: str | Column) -> Column:
    """1 / log2(rank + 1) for 1-based ranks."""
    return 1.0 / F.log2(col(rank) + 1)


def ideal_dcg(n_relevant: str | Column, k: int) -> Column:
    """sum_{i=1..min(n, k)} 1 / log2(i + 1) (0 when n = 0)."""
    m = F.least(col(n_relevant).cast("int"), F.lit(k))
    return F.when(m > 0, F.aggregate(F.sequence(F.lit(1), m), F.lit(0.0),
                                     lambda acc, i: acc + 1.0 / F.log2(i.cast("double") + 1)))\
        .otherwise(F.lit(0.0))


def hash_unit(*cols: str | Column, seed: int = 42) -> Column:
    """Deterministic pseudo-random number in [0, 1) from integer columns.

    Integer arithmetic only (no engine-specific hash), so the same value can be computed
    in SQL elsewhere: ((a * 7919 + b * 104729 + seed * 1299709) % 1000003) / 1000003. Each
    value is reduced by the modulus first, so that ids of any size stay in range.
    """
    mult = [7919, 104729, 15485863, 32452843]
    acc = F.lit(seed * 1299709).cast("long")
    for m, c in zip(mult, cols):
        acc = acc + F.pmod(col(c).cast("long"), F.lit(1000003)) * m
    return F.pmod(acc, F.lit(1000003)).cast("double") / 1000003.0
