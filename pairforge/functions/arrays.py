"""Index selection over arrays of rewards, with NumPy's tie rules.

All results are 0-based and null for an empty array.  ``argmax_first`` /
``argmin_first`` return the first index holding the extreme value (NumPy
``argmax`` / ``argmin``); ``argsort_last_two`` follows a *stable* ascending
sort, so among equal values the highest index sorts last.

NaN and null are not handled here: Spark orders NaN above every number while
NumPy comparisons are false for NaN, so callers drop such rows first
(``has_missing``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def argmax_first(arr: Column | str) -> Column:
    a = _col(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def argmin_first(arr: Column | str) -> Column:
    a = _col(arr)
    return (F.array_position(a, F.array_min(a)) - 1).cast("int")


def _last_index(a: Column, value: Column) -> Column:
    """0-based index of the last occurrence of ``value`` (null if absent)."""
    pos = F.array_position(F.reverse(a), value)
    return F.when(pos > 0, F.size(a) - pos)


def argsort_last_two(arr: Column | str) -> tuple[Column, Column]:
    """(index of the largest, index of the second largest) under a stable ascending sort.

    Native array functions only (no lambda): the largest is the last occurrence of
    the maximum; the second is the previous occurrence of the maximum if it occurs
    twice, else the last occurrence of the maximum of the rest.
    """
    a = _col(arr)
    m = F.array_max(a)
    last = _last_index(a, m)
    repeated = F.size(a) - F.size(F.array_remove(a, m)) >= 2
    before = _last_index(F.slice(a, 1, F.coalesce(last, F.lit(0))), m)
    rest_max = F.array_max(F.array_remove(a, m))
    second = F.when(repeated, before).otherwise(_last_index(a, rest_max))
    return last.cast("int"), second.cast("int")


def has_missing(arr: Column | str) -> Column:
    """True if any element is null or NaN, with native (codegen) functions only:
    ``sort_array`` puts nulls first, and ``array_max`` is NaN when a NaN is present."""
    a = _col(arr)
    has_null = (F.size(a) > 0) & F.get(F.sort_array(a), 0).isNull()
    return has_null | F.isnan(F.coalesce(F.array_max(a), F.lit(0.0)))


def is_missing(x: Column) -> Column:
    return x.isNull() | F.isnan(x)


def first_score(outputs: Column | str, field: str = "score") -> Column:
    """Scorer output ``array<struct<label, score>>`` -> the first entry's raw score."""
    return F.get(_col(outputs), 0)[field]


def array_sum(arr: Column | str) -> Column:
    return F.aggregate(_col(arr), F.lit(0.0), lambda acc, x: acc + x)
