r"""Mix sources to target weights by subset-sum budget fitting.

A document's size is its number of words ``[^\x20\x09-\x0D]+``.  The sources share a budget by weight; a source's
target stops at ``MAX_COPIES`` times its size and the excess is reshared until no target is above (``targets``).  Within a
source, documents are counted by exact size; ``fit_budget`` decides how many copies of each size are taken:

1. every size gets its proportional share, rounded down, so the mix keeps the source's length distribution;
2. what is left is used up by one more document per size, in a seeded order of sizes, until less than
   ``DP_WORDS`` words are left;
3. bounded-knapsack dynamic programming over the remaining words finds the reachable sum nearest to them.

Copies of a size are spread evenly: every document gets the whole part, and the rest goes to documents in the
order of a seeded hash.  That order is found without gathering a size's documents: counts per hash bucket say
which buckets are taken whole, and only rows of one bucket are ranked.  The solver sees one source's size
counts, as many rows as the source has distinct sizes.

Rows: a null text has size 0 and adds nothing to the mix.  A null source is a source of its own, after all others.
Repeated rows count each and are mixed each.  If all sizes are 0, targets and takes are 0.  An empty table gives an
empty result.  Equal input gives equal output; ties in the hash are between rows of equal id, text and source.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, free_name, written

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_COPIES = 2
DP_WORDS = 16_384
#: Hash buckets of a (source, size) group: rows of one bucket are ranked together.
BUCKETS = 1 << 12


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def targets(totals: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``totals`` (source, words), one row per source -> + ``target``.

    With the level L a target is ``min(MAX_COPIES * words, L * weight)``.  In ascending order of
    ``MAX_COPIES * words / weight``, the level that results if the sources before one are capped rises as long as
    capping is due and falls afterwards, so L is the largest of them.  The windows hold one row per source."""
    cap = F.col("words") * F.lit(float(MAX_COPIES))
    everything = Window.partitionBy()
    numbered = totals.withColumn("_i", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("_i") - 1, F.lit(len(weights))) + 1).cast("int"))
    before = Window.orderBy(F.col("_cap") / F.col("_w"), "_i").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.lit(share) * F.sum("words").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / \
        (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
    leveled = numbered.withColumns({"_w": weight, "_cap": cap}).withColumn("_level", level)
    return leveled.withColumn("_l", F.max("_level").over(everything)) \
        .select("source", "words", F.least("_cap", F.col("_l") * F.col("_w")).alias("target"))


def _knapsack(sizes: list[int], spare: list[int], words: int) -> list[int]:
    """How many of each size (at most ``spare``) bring the sum nearest to ``words``, below before above."""
    limit = 2 * words
    mask, reach, before, used = (1 << (limit + 1)) - 1, 1, [], []
    for i, s in enumerate(sizes):
        most = min(spare[i], limit // s)
        if not most:
            continue
        before.append(reach)
        used.append((i, most))
        step = 1
        while most:
            step = min(step, most)
            reach |= (reach << (s * step)) & mask
            most -= step
            step *= 2
        if reach >> words & 1:
            break
    best = next(t for d in range(words + 1) for t in (words - d, words + d) if reach >> t & 1)
    take = [0] * len(sizes)
    for (i, most), old in zip(reversed(used), reversed(before)):
        take[i] = next(k for k in range(most + 1) if best >= k * sizes[i] and old >> (best - k * sizes[i]) & 1)
        best -= take[i] * sizes[i]
    return take


def fit_budget(sizes: np.ndarray, counts: np.ndarray, target: float, seed: int = 0, dp_words: int = DP_WORDS) -> np.ndarray:
    """Copies to take of each (distinct, positive) size, at most ``MAX_COPIES`` per document."""
    sizes, counts = np.asarray(sizes, np.int64), np.asarray(counts, np.int64)
    total, words = int((sizes * counts).sum()), int(round(target))
    take = np.zeros(len(sizes), np.int64)
    if not total or words <= 0:
        return take
    take = np.minimum(np.floor(counts * (words / total)).astype(np.int64), MAX_COPIES * counts)
    left = words - int((sizes * take).sum())
    while left < 0:  # rounding of a huge product
        i = int(np.argmax(take > 0))
        take[i] -= 1
        left += int(sizes[i])
    order = np.random.default_rng(seed).permutation(len(sizes))
    while left > dp_words:
        fits = order[(take[order] < MAX_COPIES * counts[order]) & (sizes[order] <= left)]
        n = int(np.searchsorted(np.cumsum(sizes[fits]), left, "right"))
        if not n:
            break
        take[fits[:n]] += 1
        left -= int(sizes[fits[:n]].sum())
    spare = MAX_COPIES * counts - take
    if left > dp_words:  # every spare document is longer than what is left: one of them, or none
        open_ = np.flatnonzero(spare > 0)
        if len(open_) and int(sizes[open_].min()) < 2 * left:
            take[open_[np.argmin(sizes[open_])]] += 1
        return take
    rising = np.argsort(sizes)
    take[rising] += np.array(_knapsack(sizes[rising].tolist(), spare[rising].tolist(), left), np.int64)
    return take


def _solve(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """One source's size counts -> copies of each size."""
    pdf = pdf.sort_values("size", ignore_index=True)
    full = pdf["size"] > 0
    copies = np.zeros(len(pdf), np.int64)
    copies[full] = fit_budget(pdf.loc[full, "size"], pdf.loc[full, "n"], float(pdf["target"].iat[0]), zlib.crc32(key[0].encode()))
    return pd.DataFrame({"src": pdf["src"], "size": pdf["size"], "copies": copies, "n": pdf["n"]})


def _order(seed: str, key: str, text: str) -> Column:
    return F.xxhash64(F.lit(seed), F.col(key), F.col(text))


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, seed: str = "mix") -> DataFrame:
    """``key, size, source_size, target, taken, copies, order_hash`` for every row.

    ``order_hash`` tells rows of one id apart if their texts differ."""
    src = F.when(F.col(source).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(source).cast("string")))
    rows = written(df.select(
        F.col(key).alias("id"), src.alias("src"), F.col(source).cast("string").alias("source"),
        n_words(F.col(text)).alias("size"), _order(seed, key, text).alias("h"))
        .withColumn("bucket", F.pmod("h", F.lit(BUCKETS)).cast("int")))
    buckets = rows.groupBy("src", "size", "bucket").agg(F.count(F.lit(1)).alias("n"))
    classes = buckets.groupBy("src", "size").agg(F.sum("n").alias("n"))
    totals = rows.groupBy("src", "source").agg(F.sum("size").alias("words"))
    aims = written(targets(totals, weights, share).join(totals.select("src", F.col("source").alias("_s")),
                                                         F.col("source").eqNullSafe(F.col("_s"))).drop("_s"))
    solved = classes.join(aims.select("src", "target"), "src").groupBy("src") \
        .applyInPandas(_solve, "src string, size long, copies long, n long")
    plan = solved.select("src", "size", F.floor(F.col("copies") / F.col("n")).alias("whole"),
                         F.pmod("copies", F.col("n")).alias("extra"))
    upto = Window.partitionBy("src", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    placed = buckets.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0))).join(plan, ["src", "size"]) \
        .select("src", "size", "bucket", "whole", (F.col("extra") - F.col("before")).alias("extra"))
    in_bucket = Window.partitionBy("src", "size", "bucket").orderBy("h", "id")
    ranked = rows.withColumn("rn", F.row_number().over(in_bucket)).join(placed, ["src", "size", "bucket"])
    copies = (F.col("whole") + (F.col("rn") <= F.col("extra")).cast("long")).alias("copies")
    out = ranked.select("src", "id", "size", "h", copies).join(aims.select("src", "words", "target"), "src")
    return out.select(F.col("id").alias(key), "size", F.col("words").alias("source_size"), "target",
                      (F.col("size") * F.col("copies")).alias("taken"), "copies", F.col("h").alias("order_hash"))


def mixed_documents(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                    weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, seed: str = "mix") -> DataFrame:
    """The rows of ``df`` as often as the mix takes them; a row without words, which the mix can't weigh, stays once.

    Rows get their number of copies by (id, hash).  The plan is broadcast behind a count, else both sides are shuffled;
    rows that repeat an (id, hash) are taken once and repeated by their copies' sum."""
    name, h, k, o, n_rows = (free_name(df, c) for c in ("_copies", "_h", "_k", "_o", "_rows"))
    plan = mix(df, key, text, source, weights, share, seed).withColumn("n", F.when(F.col("size") == 0, 1).otherwise(F.col("copies")))
    plan = written(plan.groupBy(F.col(key).alias(k), F.col("order_hash").alias(o)).agg(F.sum("n").cast("int").alias(name), F.count(F.lit(1)).alias(n_rows)))
    side = F.broadcast(plan) if plan.count() <= BROADCAST_ROWS else plan
    hashed = df.withColumn(h, _order(seed, key, text))
    rows = hashed.join(side, hashed[key].eqNullSafe(side[k]) & (hashed[h] == side[o]))
    if not plan.where(F.col(n_rows) > 1).isEmpty():
        repeated = rows.where(F.col(n_rows) > 1).dropDuplicates([k, o])
        rows = rows.where(F.col(n_rows) == 1).unionByName(repeated)
    return rows.select(*[hashed[c] for c in df.columns], F.explode(F.array_repeat(F.lit(1), F.col(name))).alias(name)).drop(name)
