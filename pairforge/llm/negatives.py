r"""Hard-negative mining over integer vectors, scores by Kronecker-packed products.

Vectors become integer vectors ``floor(SCALE * x)``; a row's score is its integer inner product with an anchor.  An
anchor's positives are its ``positives`` highest rows of the same label; for each positive the hard negatives are the
first ``negatives`` rows of another label whose score lies between ``low`` and ``high`` percent of the positive's.
Higher scores come first, ties go to the smaller id.

**Kronecker packing.**  In a block of candidates every component is biased to be non-negative, and so are the anchors'
components.  Then no field of a sum of products can fall below zero, and its largest value is known: the product of an
anchor's components with the block's largest ones.  With ``bits`` for that value, ``fields`` candidates' components are
laid side by side in one wide integer (``x0 + x1 * 2**bits + ...``); one multiplication per anchor component serves all of
them, and the sum is unpacked by shifts and masks.  The biases' share, known from the plain sums of the components, is
taken off, and the scores are exact.  Where ``fields * bits`` fits 53 bits, wide integers are held in doubles, which
represent them exactly, so that a matrix product does the work; beyond that they are Python integers of any width, with
all candidates of a block in one.

**Distribution.**  Candidates are never shuffled: every task scans its own partition of the table.  Anchors, the stated
query set, go out in rounds of at most ``ROUND_BYTES`` of vectors, which is what a broadcast is bounded by; the anchors
of a round are those of one bucket of a hash.  A first scan gives the positives (anchors meet candidates of their label
only), a second one the negatives.  A task keeps the best rows per anchor and positive over all its blocks; what it
returns is bounded by anchors x positives x negatives.

Rows: a null id, a null label, a null vector, or any null or non-finite component takes no part.  Vectors score only against
vectors of as many components; empty ones score 0.  "Other" rows are those of another id.  A candidate that is repeated
takes part as often as it occurs; of anchors that repeat an id, the one of the smallest label and vector stands.
An anchor without positives, or a positive without negatives in its band, gives no row.  Scores saturate at 64 bits.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SCALE = 256.0
#: Candidates of one packed block, and anchors that meet it at once: 2,048 x 512 sums are 8 MB.
BLOCK = 2_048
ANCHOR_BLOCK = 512
#: Vectors of one round's anchors, at most about (a hash bucket is near its mean).
ROUND_BYTES = 16 << 20
#: Integers up to this many bits are exact in a double.
DOUBLE_BITS = 53
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def whole(x: np.ndarray) -> np.ndarray:
    """Doubles that are integers -> int64, or Python integers where one is too large."""
    if not x.size or np.abs(x).max() < float(1 << 62):
        return x.astype(np.int64)
    return np.array([int(v) for v in x.ravel()], dtype=object).reshape(x.shape)


class Packed:
    """A block of candidates, ``fields`` of them in one wide integer per component.

    ``x``: (rows, components) integers; ``q``: the anchors, (anchors, components)."""

    def __init__(self, x: np.ndarray, q: np.ndarray):
        self.rows, dim = x.shape
        x, q = whole(x), whole(q)
        self.bias_x, self.bias_q = -int(min(x.min(initial=0), 0)), -int(min(q.min(initial=0), 0))
        # Python integers here, for the bound itself may be wide
        top_x = [int(v) + self.bias_x for v in x.max(axis=0, initial=0)]
        top_q = [int(v) + self.bias_q for v in q.max(axis=0, initial=0)]
        # one more on both sides, so that the bound also covers each side alone
        self.bits = max(1, sum((a + 1) * (b + 1) for a, b in zip(top_x, top_q)).bit_length())
        in_double = self.bits <= DOUBLE_BITS
        self.fields = DOUBLE_BITS // self.bits if in_double else self.rows
        kind = np.int64 if in_double else object
        #: What the biases add to the sum of anchor and candidate: bias_x * sum(q) + bias_q * sum(x) + dim * both.
        self.extra_x = self.bias_q * x.astype(kind).sum(axis=1) + dim * self.bias_x * self.bias_q
        self.extra_q = self.bias_x * q.astype(kind).sum(axis=1)
        self.q = (q.astype(kind) + self.bias_q)
        biased = x.astype(kind) + self.bias_x
        self.lanes = -(-self.rows // self.fields)  # wide integers per component
        if in_double:
            padded = np.zeros((self.lanes * self.fields, dim), np.int64)
            padded[:self.rows] = biased
            wide = np.zeros((self.lanes, dim), np.int64)
            for f in range(self.fields):  # candidate f * lanes + i is field f of wide integer i
                wide += padded[f * self.lanes:(f + 1) * self.lanes] << (f * self.bits)
            self.wide = wide.astype(np.float64)
        else:
            self.wide = [sum(int(v) << (r * self.bits) for r, v in enumerate(column)) for column in biased.T]

    def scores(self, start: int, end: int) -> np.ndarray:
        """Exact scores of anchors ``start`` to ``end`` with all candidates."""
        mask = (1 << self.bits) - 1
        if isinstance(self.wide, list):
            out = np.empty((end - start, self.rows), object)
            for a in range(start, end):
                total = sum(int(v) * w for v, w in zip(self.q[a], self.wide))
                for r in range(self.rows):
                    out[a - start, r] = (total >> (r * self.bits)) & mask
            out = out - self.extra_x[None, :] - self.extra_q[start:end, None]
            return np.vectorize(lambda v: min(max(v, _LOW), _HIGH), otypes=[np.int64])(out) if out.size else out.astype(np.int64)
        else:
            sums = (self.q[start:end].astype(np.float64) @ self.wide.T).astype(np.int64)
            out = np.concatenate([(sums >> (f * self.bits)) & mask for f in range(self.fields)], axis=1)[:, :self.rows]
        return out - self.extra_x[None, :] - self.extra_q[start:end, None]


def ceil_part(score: int, percent: int) -> int:
    return -(-percent * score // 100)


class Anchors:
    """Anchors of one round and width: ids, labels, vectors, and for the second scan their positives' scores."""

    def __init__(self, ids, labels, x, positives=None):
        order = np.argsort(labels, kind="stable")
        self.ids, self.labels, self.x = ids[order], labels[order], x[order]
        #: (anchor, slot): the positives' scores, best first; None from the number of positives on
        self.positives = None if positives is None else [positives[i] for i in order]

    def of_label(self, label: int) -> tuple[int, int]:
        return int(np.searchsorted(self.labels, label, "left")), int(np.searchsorted(self.labels, label, "right"))


def _rank(keys: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best of every key: highest score, then smallest id; sorted by key."""
    order = np.lexsort((ids, ~scores, keys))  # ~s falls as s rises, without overflow
    sorted_keys = keys[order]
    first = np.searchsorted(sorted_keys, sorted_keys, "left")
    return order[np.arange(len(order)) - first < k]


class Best:
    """The ``k`` best candidates of every key over many blocks."""

    def __init__(self, k: int):
        self.k, self.held, self.size, self.kept = k, [], 0, 0

    def add(self, keys, scores, ids) -> None:
        if not len(keys):
            return
        at = _rank(keys, scores, ids, self.k)
        self.held.append((keys[at], scores[at], ids[at]))
        self.size += len(at)
        if self.size > 100_000 + 2 * self.kept:
            self.result()

    def result(self):
        if not self.held:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, scores, ids = (np.concatenate([h[i] for h in self.held]) for i in range(3))
        at = _rank(keys, scores, ids, self.k)
        self.held, self.size, self.kept = [(keys[at], scores[at], ids[at])], len(at), len(at)
        return self.held[0]


def block_positives(anchors: Anchors, ids, labels, x, best: Best) -> None:
    """Adds the best rows of the anchors' own labels, by anchor."""
    for label in np.unique(labels):
        start, end = anchors.of_label(label)
        own = np.flatnonzero(labels == label)
        if start == end:
            continue
        packed = Packed(x[own], anchors.x[start:end])
        for s in range(0, end - start, ANCHOR_BLOCK):
            e = min(s + ANCHOR_BLOCK, end - start)
            scores = packed.scores(s, e)
            mine, row = np.nonzero(anchors.ids[start + s:start + e, None] != ids[own][None, :])
            best.add(mine + start + s, scores[mine, row], ids[own][row])


def block_negatives(anchors: Anchors, ids, labels, x, band: tuple[int, int], slots: int, best: Best) -> None:
    """Adds the best rows of other labels within the band of each positive's score, by anchor * slots + slot."""
    low, high = band
    packed = Packed(x, anchors.x)
    for s in range(0, len(anchors.ids), ANCHOR_BLOCK):
        e = min(s + ANCHOR_BLOCK, len(anchors.ids))
        scores = packed.scores(s, e)
        other = (anchors.labels[s:e, None] != labels[None, :]) & (anchors.ids[s:e, None] != ids[None, :])
        for slot in range(slots):
            has = np.array([len(p) > slot for p in anchors.positives[s:e]])
            if not has.any():
                break
            score = [p[slot] if len(p) > slot else 0 for p in anchors.positives[s:e]]
            least = np.array([ceil_part(p, low) for p in score], np.int64)
            most = np.array([p * high // 100 for p in score], np.int64)
            fits = other & has[:, None] & (scores >= least[:, None]) & (scores <= most[:, None])
            mine, row = np.nonzero(fits)
            best.add((mine + s) * slots + slot, scores[mine, row], ids[row])


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, integer vectors) of a batch (id, label, vector), one per number of components."""
    ids, labels = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
    vectors = batch.column(2)
    widths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate(([0], np.cumsum(widths)[:-1])).astype(np.int64)
    for width in np.unique(widths):
        at = np.flatnonzero(widths == width)
        yield ids[at], labels[at], values[starts[at][:, None] + np.arange(width)[None, :]].reshape(len(at), int(width))


def _scan(rows: DataFrame, rounds, schema: str, per_block, k: int) -> DataFrame:
    """``per_block(anchors, ids, labels, x, best)`` over all blocks of every partition; then rows of ``best``, as (anchor
    id, slot, candidate id, score), where ``rounds`` is a broadcast of width -> ``Anchors``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, best = rounds.value, {}
        for batch in batches:
            for ids, labels, x in _vectors(batch):
                own = anchors.get(x.shape[1])
                if own is None:
                    continue
                top = best.setdefault(x.shape[1], Best(k))
                for s in range(0, len(ids), BLOCK):
                    per_block(own, ids[s:s + BLOCK], labels[s:s + BLOCK], x[s:s + BLOCK], top)
        for width, top in best.items():
            keys, scores, ids = top.result()
            slots = 1 if anchors[width].positives is None else max(map(len, anchors[width].positives), default=1) or 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors[width].ids[keys // slots], pa.int64()), pa.array(keys % slots, pa.int32()),
                 pa.array(ids, pa.int64()), pa.array(scores, pa.int64())],
                names=["anchor_id", "slot", "id", "score"])

    return rows.mapInArrow(run, schema)


def _first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The ``k`` best of all tasks' rows per key, ranked from 1."""
    best = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def _by_width(columns: list[tuple], with_positives: bool) -> dict[int, Anchors]:
    out: dict[int, list] = {}
    for row in columns:
        out.setdefault(len(row[2]), []).append(row)
    made = {}
    for width, rows in out.items():
        x = np.array([r[2] for r in rows], np.float64).reshape(len(rows), width)
        made[width] = Anchors(np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64), x,
                              [list(r[3]) for r in rows] if with_positives else None)
    return made


def _floor(x: Column) -> Column:
    """Floor of a double as a double, at any size."""
    return F.when(F.abs(x) < float(1 << 52), F.floor(x).cast("double")).otherwise(x)


def mine_negatives(df: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 10,
                   band: tuple[int, int] = (30, 90), key: str = "vec_id", vector: str = "embedding",
                   scale: float = SCALE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``is_anchor`` and ``label`` are expressions over the columns of ``df``; ids and labels are integers, and ``band`` is
    (low, high) in percent of the positive's score."""
    spark = df.sparkSession
    ints = F.transform(F.col(vector), lambda x: _floor(x.cast("double") * scale))
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double") * scale) == float("inf")))
    whole_rows = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & label.isNotNull()).where(~bad)
    rows = whole_rows.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), ints.alias("v"))
    asked = whole_rows.where(is_anchor).select(F.col(key).cast("long").alias("id"), F.struct(label.cast("long").alias("label"), ints.alias("v")).alias("r"))
    asked = written(asked.groupBy("id").agg(F.min("r").alias("r")).select("id", "r.label", "r.v"))
    size = asked.agg(F.sum(F.size("v") * 8 + 64)).first()[0] or 0
    n_rounds = max(1, -(-size // (ROUND_BYTES // 2)))
    bucket = F.pmod(F.xxhash64(F.col("id")), F.lit(n_rounds))
    schema = "anchor_id long, slot int, id long, score long"

    def rounds(anchors: DataFrame, with_positives: bool, per_block, k: int, keys: list[str]) -> DataFrame:
        out = None
        for r in range(n_rounds):
            mine = anchors.where(bucket == r) if n_rounds > 1 else anchors
            sent = _by_width([tuple(x) for x in mine.collect()], with_positives)
            if not sent and out is not None:
                continue
            found = _first(_scan(rows, spark.sparkContext.broadcast(sent), schema, per_block, k), keys, k)
            found = written(found) if n_rounds > 1 else found
            out = found if out is None else out.unionByName(found)
        return out

    best = written(rounds(asked, False, block_positives, positives, ["anchor_id"]).select(
        "anchor_id", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), "score"))
    scored = best.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("slot", "score"))).alias("p"))
    with_scores = written(asked.join(scored.withColumnRenamed("anchor_id", "id"), "id").select("id", "label", "v", F.col("p.score").alias("p")))

    def negatives_of(anchors, ids, labels, x, top):
        block_negatives(anchors, ids, labels, x, band, max(map(len, anchors.positives), default=1) or 1, top)

    hard = rounds(with_scores, True, negatives_of, negatives, ["anchor_id", "slot"])
    positive = best.select("anchor_id", "slot", "positive_id", F.col("score").alias("positive_score"))
    return hard.join(positive, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))

