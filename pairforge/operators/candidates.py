"""Candidate sets: long <-> wide, prompt join, completeness and length filters.

Wide form: ``row_id, prompt, responses array<string>[, rewards array<double>]``.
Long form: one row per ``(row_id, k)``.  The iteration driver stays wide from
generation to pairs (no shuffle at all); the long form serves data that arrives
one response per row (a per-response scoring service, merged shard files), and
``to_wide`` brings it back with one shuffle on ``row_id`` whose groups hold a
prompt's K responses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.chat import render_chat


def to_long(df: DataFrame, arrays: Sequence[str] = ("responses", "rewards"),
            names: Sequence[str] = ("response", "reward"), key: str = "row_id",
            keep: Sequence[str] = ()) -> DataFrame:
    """Wide -> long with ``k`` = position.  Row-local (``posexplode``), no shuffle."""
    zipped = F.arrays_zip(*[F.col(a).alias(n) for a, n in zip(arrays, names)])
    out = df.select(key, *keep, F.posexplode(zipped).alias("k", "_z"))
    return out.select(key, *keep, F.col("k").cast("int").alias("k"),
                      *[F.col("_z")[n].alias(n) for n in names])


def to_wide(df: DataFrame, key: str = "row_id", index: str = "k",
            values: Sequence[str] = ("response", "reward"),
            arrays: Sequence[str] = ("responses", "rewards"),
            carry: Sequence[str] = ()) -> DataFrame:
    """Long -> wide, arrays in index order.

    One shuffle on ``key``; each group is one prompt's K candidates.
    ``collect_list`` has no order, so entries carry their index and are sorted.
    ``carry`` columns are constant per key (e.g. the prompt) and ride along.
    """
    packed = F.array_sort(F.collect_list(F.struct(F.col(index).alias("_i"), *[F.col(v) for v in values])))
    grouped = df.groupBy(key).agg(packed.alias("_packed"), *[F.first(c).alias(c) for c in carry])
    return grouped.select(key, *carry,
                          *[F.transform("_packed", _field(v)).alias(a) for v, a in zip(values, arrays)])


def _field(name: str):
    return lambda s: s[name]


def join_candidates(prompts: DataFrame, responses: DataFrame, key: str = "row_id",
                    prompt_key: str = "context_messages", strict: bool = False) -> DataFrame:
    """J1 + P7: prompt rows joined 1:1 to their responses (inner equi-join on ``row_id``).

    ``strict`` raises when a prompt has no responses (the server path fails the run).
    """
    left = prompts.select(key, F.col(prompt_key).alias("prompt"))
    if strict:
        missing = left.join(responses.select(key), key, "left_anti").limit(1).count()
        if missing:
            raise RuntimeError("some prompts have no responses")
    return left.join(responses, key, "inner")


def drop_short(df: DataFrame, k: int, responses: str = "responses") -> DataFrame:
    """keep rows with at least ``k`` responses (more than ``k`` are kept)."""
    if k < 0:
        raise ValueError("k must be >= 0")
    return df.filter(F.size(responses) >= F.lit(k))


def overlength_guard(df: DataFrame, max_input_length: int, prompt_text: Column,
                     responses: str = "responses") -> DataFrame:
    """A prompt whose rendered text is longer than ``max_input_length``
    characters gets no responses (F1 drops it later)."""
    empty = F.array().cast("array<string>")
    return df.withColumn(
        responses, F.when(F.length(prompt_text) > F.lit(max_input_length), empty).otherwise(F.col(responses))
    )


def render_prompts(df: DataFrame, messages: str = "context_messages", out: str = "prompt_text",
                   bos: str | None = None) -> DataFrame:
    """P2 over a prompt table: rendered text with the generation header."""
    kwargs = {} if bos is None else {"bos": bos}
    return df.withColumn(out, render_chat(F.col(messages), add_generation_prompt=True, **kwargs))
