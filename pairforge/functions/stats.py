"""Numerically stable scalar functions used by the preference losses; null in, null out
(``greatest`` and ``least`` would skip a null)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: log of the largest double, floored to 4 decimals (the exponent cap
# applied before ``exp`` in the alpha-divergence logits).
EXP_CAP_DOUBLE = 709.7827


def log_sigmoid(x: Column) -> Column:
    """log(sigmoid(x)) = min(x, 0) - log1p(exp(-|x|)); no overflow for any x."""
    return F.when(x >= 0, F.lit(0.0)).otherwise(x) - F.log1p(F.exp(-F.abs(x)))


def softplus(x: Column) -> Column:
    """log(1 + exp(x)) = max(x, 0) + log1p(exp(-|x|))."""
    return F.when(x <= 0, F.lit(0.0)).otherwise(x) + F.log1p(F.exp(-F.abs(x)))


def sigmoid(x: Column) -> Column:
    e = F.exp(-F.abs(x))
    return F.when(x >= 0, 1.0 / (1.0 + e)).otherwise(e / (1.0 + e))


def cap_exp(x: Column, cap: float = EXP_CAP_DOUBLE) -> Column:
    return F.exp(F.when(x >= cap, F.lit(cap)).otherwise(x))


def relu(x: Column) -> Column:
    return F.when(x <= 0, F.lit(0.0)).otherwise(x)


def log_sum_exp(logits: Column, row_max: Column | None = None) -> Column:
    """log(sum(exp(logits))) with the max shift.

    ``row_max``: ``array_max(logits)`` already materialised in a column below a
    plan barrier (e.g. a join); the fold is then a plain double sum.  Without it,
    the max rides in the fold's initial accumulator, which is evaluated once per
    row -- a max referenced inside the lambda would be recomputed per element.
    """
    if row_max is not None:
        return row_max + F.log(F.aggregate(logits, F.lit(0.0), lambda acc, v: acc + F.exp(v - row_max)))
    start = F.struct(F.array_max(logits).alias("m"), F.lit(0.0).alias("s"))
    return F.aggregate(
        logits, start,
        lambda acc, v: F.struct(acc["m"].alias("m"), (acc["s"] + F.exp(v - acc["m"])).alias("s")),
        lambda acc: acc["m"] + F.log(acc["s"]),
    )


def log_softmax_at(logits: Column, index: Column, row_max: Column | None = None) -> Column:
    """logits[index] - logsumexp(logits)."""
    return F.get(logits, index) - log_sum_exp(logits, row_max)
