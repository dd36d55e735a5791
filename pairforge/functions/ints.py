"""Exact integer helpers (no detour through doubles)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def idiv(c: Column, n: int | Column) -> Column:
    """Integral division ``c div n`` (truncates toward zero, long result)."""
    return F.call_function("div", c, n if isinstance(n, Column) else F.lit(n))
