"""Score summaries and counts.

All are global or low-cardinality aggregations: partial aggregation runs
map-side, so only one small row per task crosses the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import array_sum


def _reward_aggs(rewards: Column, keep: Column | None = None) -> list[Column]:
    """A2 (element-weighted mean of all rewards) and A1 (mean of each row's max)."""
    rewards = F.array_compact(rewards)  # a null reward counts neither in the sum nor in the size
    total = array_sum(rewards)
    size = F.size(rewards).cast("long")
    best = F.array_max(rewards)
    if keep is not None:
        total, size, best = F.when(keep, total), F.when(keep, size), F.when(keep, best)
    return [
        (F.sum(total) / F.sum(size)).alias("mean_score"),
        F.avg(best).alias("top1_score"),
    ]


def score_summary(candidates: DataFrame, k: int, rewards: str = "rewards",
                  responses: str = "responses") -> DataFrame:
    """A1-A3 in one pass over the candidate sets *before* F1:
    ``n_input, n_collected, short, mean_score, top1_score`` (scores over the
    rows that pass F1; null when none do)."""
    full = F.size(responses) >= F.lit(k)
    agg = candidates.agg(
        F.count(F.lit(1)).alias("n_input"),
        F.count_if(full).cast("long").alias("n_collected"),
        *_reward_aggs(F.col(rewards), full),
    )
    return agg.select("n_input", "n_collected", (F.col("n_collected") < F.col("n_input")).alias("short"),
                      "mean_score", "top1_score")


def run_record(scored: DataFrame, iteration: str = "iteration", rewards: str = "rewards") -> DataFrame:
    """One row per iteration with its mean and top-1 scores (and row count)."""
    return scored.groupBy(iteration).agg(
        F.count(F.lit(1)).alias("n"),
        *_reward_aggs(F.col(rewards)),
    )


def shard_counts(df: DataFrame, shard: str = "shard") -> DataFrame:
    """A5: rows per shard."""
    return df.groupBy(shard).agg(F.count(F.lit(1)).alias("n"))
