"""Exact top-k inner-product search over an impact-ordered, score-at-a-time index.

Vectors become integer vectors ``floor(SCALE * x)``.  The index cuts the
candidates into blocks of at most ``BLOCK`` rows.  In a block every component is a
posting (dimension, row, value); postings are put in segments by the quantised
impact (the size of the value in powers of two), and each row keeps the norm of what
lies below every impact level.  A block of queries meets a block of candidates:
segments are processed by descending impact, all dimensions of a level at once,
into one accumulator per (query, row).  After each level a row's score lies within
``|q| * (its norm below that level)`` of the accumulator (Cauchy-Schwarz).  A query
stops only on proof: once at most ``SMALL`` rows, or no row at all outside the
k-th best lower bound, can still be among its k best.  Possible members are then
rescored exactly in integers; ties go to the smaller id.

The queries are a stated set of rows, cut in blocks as well; a pair of blocks is
one task's work, so neither side is broadcast or gathered.  Per query and
candidate block at most k rows leave a task; the k best of those are exact.

Rows: vectors that are null, or hold a null or a component that isn't finite,
take no part.  Vectors score only against vectors of as many components; empty
vectors score 0.  A repeated row takes part as often as it occurs and is a
candidate of rows with another id only.  Fewer than k candidates give
as many rows; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, written

SCALE = 256.0
BLOCK = 4_096
QUERY_BLOCK = 512
SMALL = 64
#: No proof is tried while more than this share of the squared norm is unprocessed.
UNPROCESSED = 0.15
#: Beyond this bound on a score, products are taken in Python integers instead of doubles.
EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


def impact_levels(x: np.ndarray) -> np.ndarray:
    """Quantised impact of every value: 0 for 0, else the number of bits of its size."""
    return np.where(x == 0, 0, np.frexp(np.abs(x))[1])


class ImpactIndex:
    """Segments of one candidate block, highest impact first."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        levels = impact_levels(x)
        self.segments: list[tuple[np.ndarray, np.ndarray]] = []  # (postings of the level, norms below it)
        for level in sorted(set(np.unique(levels)) - {0}, reverse=True):
            self.segments.append((np.where(levels == level, x, 0.0), np.sqrt((np.where(levels < level, x, 0.0) ** 2).sum(1))))

    def top(self, qids: np.ndarray, q: np.ndarray, k: int) -> tuple[list[tuple[int, int, int]], int]:
        """((query id, id, score) of each query's k best in the block, number of segment passes)."""
        n, found, passes = len(self.ids), [], 0
        left = np.arange(len(qids))  # queries not yet proven
        score = np.zeros((len(qids), n))
        norms, energy = np.sqrt((q ** 2).sum(1)), (self.x ** 2).sum()
        slack = 1e-9 * (norms[:, None] * max([np.sqrt((self.x ** 2).sum(1).max()), 1.0]) + 1.0)
        own = self.ids[None, :] == qids[:, None]
        for i, (postings, below) in enumerate(self.segments):
            passes += len(left)
            score[left] += q[left] @ postings.T
            if i == len(self.segments) - 1:
                break
            if n - 1 <= k or (below ** 2).sum() > UNPROCESSED * energy:
                continue
            bound = norms[left, None] * below[None, :] + slack[left]
            low = np.where(own[left], -np.inf, score[left] - bound)
            kth = np.partition(low, n - k, axis=1)[:, n - k]
            possible = (score[left] + bound >= kth[:, None]) & ~own[left]
            done = possible.sum(1) <= SMALL
            for at in np.flatnonzero(done):
                found += self._rescore(int(qids[left[at]]), q[left[at]], np.flatnonzero(possible[at]), k)
            left = left[~done]
            if not len(left):
                break
        for at in left:  # every segment is processed: scores are exact up to rounding
            row = np.where(own[at], -np.inf, score[at])
            kth = np.partition(row, max(n - k, 0))[max(n - k, 0)] if n else 0.0
            found += self._rescore(int(qids[at]), q[at], np.flatnonzero((row >= kth - 2 * slack[at]) & ~own[at]), k)
        return found, passes

    def _rescore(self, qid: int, q: np.ndarray, rows: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        x = self.x[rows]
        if len(rows) and float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(len(q), 1) >= EXACT:
            exact = [max(-_LONG - 1, min(_LONG, sum(int(a) * int(b) for a, b in zip(q, row)))) for row in x]
            order = sorted(range(len(rows)), key=lambda i: (-exact[i], self.ids[rows[i]]))[:k]
            return [(qid, int(self.ids[rows[i]]), exact[i]) for i in order]
        exact = (x @ q).astype(np.int64)
        order = np.lexsort((self.ids[rows], -exact))[:k]
        return [(qid, int(self.ids[rows[i]]), int(exact[i])) for i in order]


def _blocks(df: DataFrame, rows: int) -> DataFrame:
    """(dim, block, ids, data): up to ``rows`` vectors of one width per row, int64 ids and float64 data in binary.
    ``block`` numbers the blocks by partition; it is read only from a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        number = (TaskContext.get().partitionId() << 32) - 1

        def out(dim: int) -> pa.RecordBatch:
            nonlocal number
            number += 1
            own = held.pop(dim)
            ids = np.array([i for i, _ in own], np.int64)
            data = np.array([v for _, v in own], np.float64).reshape(len(own), dim)
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([number], pa.int64()), pa.array([ids.tobytes()], pa.binary()),
                 pa.array([data.tobytes()], pa.binary())], names=["dim", "block", "ids", "data"])

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.setdefault(len(v), []).append((i, v))
                if len(held[len(v)]) >= rows:
                    yield out(len(v))
        for dim in list(held):
            yield out(dim)

    return df.mapInArrow(run, "dim int, block long, ids binary, data binary")


def _read(ids: bytes, data: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    own = np.frombuffer(ids, np.int64)
    return own, np.frombuffer(data, np.float64).reshape(len(own), dim)


def top_k(df: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding",
          scale: float = SCALE, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k highest integer inner products with rows of another id.

    ``is_query`` is a condition on the id column, which is called ``key``."""
    small_batches(df.sparkSession, 2_000)
    ints = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("double"))
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = df.select(F.col(key), F.col(vector)).where(F.col(vector).isNotNull() & F.col(key).isNotNull()).where(~bad) \
        .select(F.col(key), ints.alias("_v"))
    asked = rows.where(is_query)
    queries = written(_blocks(asked.repartition(max(1, -(-asked.count() // QUERY_BLOCK))), QUERY_BLOCK))
    # every candidate block meets every query block of its width; copies of the query blocks spread the work
    parallel = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = max(1, -(-parallel // max(1, queries.count())))
    salted = queries.select("dim", F.col("block").alias("qb"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"),
                            F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    widths = queries.groupBy("dim").agg(F.collect_list("block").alias("qbs"))
    cands = _blocks(rows, block).join(widths, "dim").select(
        "dim", F.explode("qbs").alias("qb"), F.pmod(F.xxhash64("ids"), F.lit(salts)).cast("int").alias("salt"),
        F.col("ids").alias("c_ids"), F.col("data").alias("c_data"))
    pairs = cands.join(salted, ["dim", "qb", "salt"])

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                found, _ = ImpactIndex(*_read(r.c_ids, r.c_data, r.dim)).top(*_read(r.q_ids, r.q_data, r.dim), k)
                yield pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    part = pairs.select("dim", "c_ids", "c_data", "q_ids", "q_data") \
        .mapInPandas(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return part.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k) \
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
