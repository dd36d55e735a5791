"""Preference-pair selection.

Everything is row-local: one ``Project`` + ``Filter`` over the wide scored
table, no shuffle and no Python.  Input columns: ``row_id``, ``prompt``
(message list), ``responses`` (array<string>), ``rewards`` (array<double>).

Strategies (indices are 0-based):

* ``random``      indices 0 and 1 (not random).
* ``max_random``  first argmax, then 1 if that is 0, else 0 (not random).
* ``max_min``     first argmax and first argmin.
* ``max_max``     the last two of a stable ascending sort (best and second best;
                  among equal rewards the higher index counts as larger).
* ``max_min_p``   first argmax / argmin of ``reward - length_penalty * len(response)``;
                  orientation, tie test and margin use the raw rewards.

The response with the higher raw reward becomes ``chosen``; equal raw rewards
emit nothing.  A row whose compared rewards include NaN/null emits nothing
(``max_*``: any NaN/null in the row; ``random``: NaN/null in the first two).
Rows with fewer than two responses are dropped (``strict=False``) or raise.  A row
whose responses and rewards differ in number, or one of whose two selected
responses is null, emits nothing and counts as ``uneven``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import argmax_first, argmin_first, argsort_last_two, has_missing, is_missing
from ..functions.chat import DEFAULT_BOS, render_chat

STRATEGIES = ("random", "max_random", "max_min", "max_max", "max_min_p")

OUTCOMES = ("kept", "tied", "nan", "short", "uneven")


def _check_strategy(choose_type: str) -> None:
    if choose_type not in STRATEGIES:
        raise ValueError(f"unknown choose_type {choose_type!r}; expected one of {STRATEGIES}")


def penalised(rewards: Column, responses: Column, length_penalty: float) -> Column:
    """``reward_i - length_penalty * len(response_i)`` (characters; a null response has none)."""
    lam = F.lit(float(length_penalty))
    return F.zip_with(rewards, responses, lambda r, t: r - lam * F.coalesce(F.length(t), F.lit(0)))


def select_indices(choose_type: str, rewards: Column, responses: Column,
                   length_penalty: float = 0.0) -> tuple[Column, Column]:
    """(idx0, idx1) for one strategy, as int Columns."""
    _check_strategy(choose_type)
    if choose_type == "random":
        return F.lit(0), F.lit(1)
    if choose_type == "max_random":
        i0 = argmax_first(rewards)
        return i0, F.when(i0 == 0, F.lit(1)).otherwise(F.lit(0))
    if choose_type == "max_min":
        return argmax_first(rewards), argmin_first(rewards)
    if choose_type == "max_max":
        return argsort_last_two(rewards)
    p = penalised(rewards, responses, length_penalty)
    return argmax_first(p), argmin_first(p)


def outcome(choose_type: str, rewards: Column, r0: Column, r1: Column, responses: Column, t0: Column, t1: Column) -> Column:
    """A4 outcome of one row: kept / tied / nan / short / uneven."""
    n = F.size(rewards)
    if choose_type == "random":
        missing = is_missing(r0) | is_missing(r1)
    else:
        missing = has_missing(rewards)
    return (
        F.when(n.isNull() | (n < 2), F.lit("short"))
        .when(F.size(responses) != n, F.lit("uneven"))
        .when(missing, F.lit("nan"))
        .when(t0.isNull() | t1.isNull(), F.lit("uneven"))
        .when(r0 == r1, F.lit("tied"))
        .otherwise(F.lit("kept"))
    )


def _annotate(df: DataFrame, choose_type: str, length_penalty: float,
              rewards: str, responses: str) -> DataFrame:
    rw, rs = F.col(rewards), F.col(responses)
    if choose_type == "max_min_p":
        # the penalised array is a lambda over every response: compute it once
        df = df.withColumn("_pen", penalised(rw, rs, length_penalty))
        i0, i1 = argmax_first(F.col("_pen")), argmin_first(F.col("_pen"))
    else:
        i0, i1 = select_indices(choose_type, rw, rs, length_penalty)
    return (
        df.withColumn("_i0", i0)
        .withColumn("_i1", i1)
        .withColumn("_r0", F.get(rw, F.col("_i0")))
        .withColumn("_r1", F.get(rw, F.col("_i1")))
        .withColumn("_t0", F.get(rs, F.col("_i0")))
        .withColumn("_t1", F.get(rs, F.col("_i1")))
        .withColumn("_outcome", outcome(choose_type, rw, F.col("_r0"), F.col("_r1"), rs, F.col("_t0"), F.col("_t1")))
    )


def build_pairs(df: DataFrame, choose_type: str, margin_scale: float = 1.0,
                length_penalty: float = 0.0, eot_token: str = "", bos: str = DEFAULT_BOS,
                strict: bool = False, prompt: str = "prompt", rewards: str = "rewards",
                responses: str = "responses", keep: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """Scored wide rows -> ``keep + (prompt, chosen, rejected, margin)``.

    ``prompt`` is rendered with the generation header (P2); ``eot_token`` is
    appended to both responses (P9); ``margin = (hi - lo) * margin_scale`` on raw
    rewards (P10).
    """
    _check_strategy(choose_type)
    if choose_type != "max_min_p" and length_penalty:
        raise ValueError("length_penalty applies to max_min_p only")
    a = _annotate(df, choose_type, length_penalty, rewards, responses)
    if strict:
        a = a.withColumn(
            "_outcome",
            F.when(F.col("_outcome") == "short",
                   F.raise_error(F.lit("a candidate set has fewer than two responses"))).otherwise(F.col("_outcome")),
        )
    r0, r1 = F.col("_r0"), F.col("_r1")
    t0, t1 = F.col("_t0"), F.col("_t1")
    first_wins = r0 > r1
    eot = F.lit(eot_token)
    cols = [
        *[F.col(c) for c in keep],
        render_chat(F.col(prompt), bos=bos, add_generation_prompt=True).alias("prompt"),
        F.concat(F.when(first_wins, t0).otherwise(t1), eot).alias("chosen"),
        F.concat(F.when(first_wins, t1).otherwise(t0), eot).alias("rejected"),
        (F.when(first_wins, r0 - r1).otherwise(r1 - r0) * F.lit(float(margin_scale))).alias("margin"),
    ]
    kept = F.col("_outcome") == "kept"
    if choose_type in ("max_min_p", "max_max"):
        # A Filter would be pushed below the projections with the aliases inlined,
        # re-running the lambda over all responses (or the two stable argsort indices) once
        # per reference; a generator over a 0-or-1 element array evaluates them once per row.
        return a.select(F.inline(F.when(kept, F.array(F.struct(*cols)))))
    # cheap native selection: a plain Filter stays inside whole-stage codegen
    return a.filter(kept).select(*cols)


def pair_outcomes(df: DataFrame, strategies: tuple[str, ...] = STRATEGIES,
                  length_penalty: float = 0.0, rewards: str = "rewards",
                  responses: str = "responses") -> DataFrame:
    """A4: ``(strategy, outcome, n)`` for every strategy in one scan.

    Each row gets one outcome per strategy (row-local), the outcomes are
    unpivoted with ``stack`` and counted; the count is a partial (map-side)
    aggregation over at most ``5 strategies x 5 outcomes`` keys.
    """
    rw, rs = F.col(rewards), F.col(responses)
    cols = []
    if "max_min_p" in strategies:  # a lambda over every response: once per row, below the explode
        df = df.withColumn("_pen", penalised(rw, rs, length_penalty))
    for s in strategies:
        _check_strategy(s)
        i0, i1 = (argmax_first(F.col("_pen")), argmin_first(F.col("_pen"))) if s == "max_min_p" else select_indices(s, rw, rs)
        cols.append(F.struct(F.lit(s).alias("strategy"),
                             outcome(s, rw, F.get(rw, i0), F.get(rw, i1), rs, F.get(rs, i0), F.get(rs, i1)).alias("outcome")))
    per_row = df.select(F.explode(F.array(*cols)).alias("_o"))
    return per_row.groupBy(F.col("_o.strategy").alias("strategy"), F.col("_o.outcome").alias("outcome")) \
        .agg(F.count(F.lit(1)).alias("n"))


IndexLists = Callable[[Column, Column], tuple[Column, Column]]


def best_vs_rest(rewards: Column, responses: Column) -> tuple[Column, Column]:
    """Example list strategy for C7: the first argmax against every other index."""
    best = argmax_first(rewards)
    others = F.filter(F.sequence(F.lit(0), F.size(rewards) - 1), lambda i: i != best)
    return F.array_repeat(best, F.size(others)), others


def build_pairs_multi(df: DataFrame, index_lists: IndexLists, margin_scale: float = 1.0,
                      eot_token: str = "", bos: str = DEFAULT_BOS, prompt: str = "prompt",
                      rewards: str = "rewards", responses: str = "responses",
                      keep: tuple[str, ...] = ("row_id",)) -> DataFrame:
    """A strategy that returns equal-length index *lists* emits one pair per
    position, with no orientation and no tie drop (the margin may be <= 0)."""
    rw, rs = F.col(rewards), F.col(responses)
    idx0, idx1 = index_lists(rw, rs)
    checked = F.when(F.size(idx0) == F.size(idx1), F.arrays_zip(idx0.alias("a"), idx1.alias("b"))) \
        .otherwise(F.raise_error(F.lit("index lists differ in length")))
    ex = df.select(*keep, F.col(prompt), rw.alias("_rw"), rs.alias("_rs"),
                   F.posexplode(checked).alias("pair_idx", "_ab"))
    a, b = F.col("_ab.a"), F.col("_ab.b")
    eot = F.lit(eot_token)
    return ex.select(
        *keep,
        F.col("pair_idx").cast("long").alias("pair_idx"),
        render_chat(F.col(prompt), bos=bos, add_generation_prompt=True).alias("prompt"),
        F.concat(F.get(F.col("_rs"), a), eot).alias("chosen"),
        F.concat(F.get(F.col("_rs"), b), eot).alias("rejected"),
        ((F.get(F.col("_rw"), a) - F.get(F.col("_rw"), b)) * F.lit(float(margin_scale))).alias("margin"),
    )


EVAL_LIMIT = 100


def build_eval_pairs(df: DataFrame, eot_token: str = "", margin_scale: float = 1.0,
                     bos: str = DEFAULT_BOS, order_by: str = "row_id", limit: int | None = EVAL_LIMIT) -> DataFrame:
    """Eval pairs use ``random`` without length penalty; the first ``limit`` by row order (L2), or all
    with ``None``."""
    from .ordering import head_n

    pairs = build_pairs(df, "random", margin_scale=margin_scale, eot_token=eot_token, bos=bos)
    return head_n(pairs, limit or 0, order_by=order_by)
