"""Order-dependent operators without a single-task sort.

Spark rows have no position, so every table carries an integer key (``row_id``).
One operator gives positions to ordinals, shards and the shuffle
(``global_positions``): rows are range-partitioned by the order columns, sorted
within their range, and numbered by the low 33 bits of
``monotonically_increasing_id``; the numbered rows are written once, and the
ranges' prefix offsets (one row per range) make the numbers global.  The input
is read twice (the sample for the range bounds, and the exchange) whatever its
size, any 64-bit key works, and null keys are an error.

``range_scan`` is the same with running sums and segment starts: packing (T8), the
running mean of ``bco_pair`` (X6) and rank pairing (J3) use it.  Sums run within a
range, and one row per range carries them on, so neither a key's value nor a hot key
decides how much a task gets.

There are as many ranges as the session has shuffle partitions; adaptive execution
merges small ones by the bytes that were really written.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ints import idiv
from ..session import shared_dir


def head_n(df: DataFrame, n: int, order_by: str | Sequence[str] = "row_id",
           strict: bool = False) -> DataFrame:
    """L1: the first ``n`` rows in key order (``TakeOrderedAndProject``: each task
    keeps its top ``n``).  ``n <= 0`` means no limit (F4)."""
    if n is None or n <= 0:
        return df
    cols = [order_by] if isinstance(order_by, str) else list(order_by)
    out = df.orderBy(*cols).limit(n)
    if strict and out.count() < n:
        raise ValueError(f"asked for {n} rows, fewer exist")
    return out


SANITY_ROWS = 100


def sanity_cut(df: DataFrame, enabled: bool = True, order_by: str = "row_id", rows: int = SANITY_ROWS) -> DataFrame:
    """L2: ``min(len, rows)`` rows after pair building; ``rows <= 0`` keeps all."""
    return head_n(df, rows, order_by) if enabled else df


def required(column: Column | str, what: str) -> Column:
    """The column, failing the query where it is null."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(c.isNull(), F.raise_error(F.lit(f"{what} must not be null"))).otherwise(c)


def _in_ranges(df: DataFrame, order: Sequence[str], partitions: int | None) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``; a per-row salt is the last order column, so that copies of a row
    spread over ranges (their mutual order is free)."""
    shared_dir(df.sparkSession)  # checkpoint folder: the cluster's, or a local one in tests
    salted = df.withColumn("_salt", F.monotonically_increasing_id())
    columns = [*order, "_salt"]
    ranged = salted.repartitionByRange(partitions, *columns) if partitions else salted.repartitionByRange(*columns)
    return ranged.sortWithinPartitions(*columns).drop("_salt")


def global_positions(df: DataFrame, order: Sequence[str], out: str = "_pos",
                     partitions: int | None = None) -> DataFrame:
    """0-based position of every row in ``order`` without a single-task sort.

    The numbered rows are written to the shared folder, so that every reference
    sees the same ranges.
    """
    numbered = _in_ranges(df, order, partitions).withColumn("_m", F.monotonically_increasing_id())
    numbered = numbered.withColumns({"_range": F.shiftright("_m", 33).cast("int"),
                                     "_index": F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_m").checkpoint()
    counts = numbered.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = numbered.join(F.broadcast(offsets), "_range")  # one row per range
    return placed.withColumn(out, F.col("_before") + F.col("_index")).drop("_range", "_index", "_before")


def range_scan(df: DataFrame, order: Sequence[str], sums: Sequence[str] = (), segment: Sequence[str] = (),
               out: str = "_pos", suffix: str = "_before", start: str = "_start", partitions: int | None = None) -> DataFrame:
    """``global_positions`` with running sums and segment starts.

    Adds to every row its position ``out``; for each of ``sums`` (``long`` or ``double``) the sum over the rows before
    it, as ``<v><suffix>``; and with ``segment`` (leading columns of ``order``) the position ``start`` of the first row of
    its segment, the rows equal in these columns.  ``order`` decides between rows of one key; rows equal in all of it are
    interchangeable.  Nulls in ``sums`` are an error.

    A task scans its sorted range once (Arrow batches, running totals carried along) and writes it; the ranges'
    totals, and where their last segment began, are one row per range and go back as offsets.  A segment
    that fills many ranges is handed on from range to range, not gathered.
    """
    df = df.withColumns({v: required(v, f"a summand ({v})") for v in sums}) if sums else df
    ranged = _in_ranges(df, order, partitions)
    kinds = {v: ranged.schema[v].dataType for v in sums}
    more = [("_range", T.IntegerType()), ("_index", T.LongType()), ("_seg", T.LongType()), *[(f"_in_{v}", kinds[v]) for v in sums]]
    schema = T.StructType([*ranged.schema.fields, *[T.StructField(name, kind) for name, kind in more]])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, at, began, last = TaskContext.get().partitionId(), 0, 0, None
        carry = {v: 0 for v in sums}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            index, new = np.arange(at, at + n), np.zeros(n, bool)
            for c in segment:
                column = batch.column(c)
                new[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            head = [batch.column(c)[0].as_py() for c in segment]
            new[0] = last is None or head != last
            last = [batch.column(c)[n - 1].as_py() for c in segment]
            starts = np.maximum.accumulate(np.where(new, index, began))
            added = [np.full(n, number, np.int32), index, starts]
            for v in sums:
                x = batch.column(v).to_numpy(zero_copy_only=False)
                total = np.cumsum(np.concatenate(([carry[v]], x)), dtype=x.dtype)
                carry[v] = total[-1]
                added.append(total[:-1])
            at, began = at + n, int(starts[-1])
            for (name, _), values in zip(more, added):
                batch = batch.append_column(name, pa.array(values))
            yield batch

    scanned = ranged.mapInArrow(scan, schema).checkpoint()
    key = F.struct(*[F.col(c) for c in segment]) if segment else F.lit(0)
    ranges = scanned.groupBy("_range").agg(
        F.count(F.lit(1)).alias("_n"), F.max("_seg").alias("_last_seg"), F.min_by(key, "_index").alias("_first_key"),
        F.max_by(key, "_index").alias("_last_key"), *[F.sum(v).alias(f"_sum_{v}") for v in sums])
    by_range = Window.orderBy("_range")
    before = by_range.rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumns({
        "_off": F.coalesce(F.sum("_n").over(before), F.lit(0)),
        "_same": F.coalesce(F.col("_first_key") == F.lag("_last_key").over(by_range), F.lit(False)),
        **{f"_off_{v}": F.coalesce(F.sum(f"_sum_{v}").over(before), F.lit(0).cast(kinds[v])) for v in sums}})
    # where the segment that is open at a range's end began, unless it came in from the range before
    opened = F.when(~F.col("_same") | (F.col("_last_seg") > 0), F.col("_off") + F.col("_last_seg"))
    offsets = ranges.withColumn("_opened", opened).select(
        "_range", "_off", F.when(F.col("_same"), F.last("_opened", ignorenulls=True).over(before)).alias("_came_in"), *[f"_off_{v}" for v in sums])
    placed = scanned.join(F.broadcast(offsets), "_range")  # one row per range
    columns = [*[F.col(c) for c in df.columns], (F.col("_off") + F.col("_index")).alias(out)]
    columns += [(F.col(f"_off_{v}") + F.col(f"_in_{v}")).alias(v + suffix) for v in sums]
    if segment:
        came_in = F.when(F.col("_seg") == 0, F.col("_came_in"))
        columns.append(F.coalesce(came_in, F.col("_off") + F.col("_seg")).alias(start))
    return placed.select(*columns)


def with_ordinal(df: DataFrame, key: str = "row_id", out: str = "ordinal",
                 tiebreak: Sequence[str] = ()) -> DataFrame:
    """Dense 0-based ordinal in ``key`` order; ``tiebreak`` columns order rows that
    share a key.  A null key fails the query."""
    return global_positions(df.withColumn(key, required(key, f"the order key {key}")), [key, *tiebreak], out)


def shard_floor(df: DataFrame, w: int, drop_tail: bool, key: str = "row_id", out: str = "shard") -> DataFrame:
    """L3: ``share = n div w``; shard i = ordinals ``[i*share, (i+1)*share)``.

    With ``drop_tail`` (the reference behaviour) the last ``n mod w`` rows are in
    no shard; otherwise they join the last shard.  ``n < w`` gives no rows with
    ``drop_tail``, else one shard.
    """
    if w <= 0:
        raise ValueError("w must be positive")
    o = with_ordinal(df, key, "ordinal")
    share = o.count() // w
    if share == 0:
        return o.withColumn(out, F.lit(w - 1)).filter(F.lit(not drop_tail))
    shard = idiv(F.col("ordinal"), share).cast("int")
    if drop_tail:
        return o.withColumn(out, shard).filter(F.col(out) < w)
    return o.withColumn(out, F.least(shard, F.lit(w - 1)))


def shard_cover(df: DataFrame, w: int, key: str = "row_id", out: str = "shard") -> DataFrame:
    """L4: ``share = n div w + 1``; loses nothing, late shards may be short or empty."""
    if w <= 0:
        raise ValueError("w must be positive")
    o = with_ordinal(df, key, "ordinal")
    share = o.count() // w + 1
    return o.withColumn(out, idiv(F.col("ordinal"), share).cast("int"))


def shard_round_robin(df: DataFrame, w: int, key: str = "row_id", out: str = "shard") -> DataFrame:
    """shard = ordinal mod w."""
    if w <= 0:
        raise ValueError("w must be positive")
    o = with_ordinal(df, key, "ordinal")
    return o.withColumn(out, F.pmod(F.col("ordinal"), F.lit(w)).cast("int"))


def shuffle_key(seed: int | str, key: str = "row_id") -> Column:
    """L6 sort key: the first 60 bits of ``md5(seed || ':' || key)`` (non-negative long)."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def shuffle(df: DataFrame, seed: int | str, key: str = "row_id", out: str = "position") -> DataFrame:
    """Seeded, repeatable global shuffle; ``position`` = dense rank in hash order.

    ``rand()`` is not stable under recomputation; a hash of (seed, key) is.
    """
    h = df.withColumn("_h", shuffle_key(seed, key))
    placed = with_ordinal(h, "_h", out, tiebreak=[key])
    return placed.drop("_h")


def in_order(df: DataFrame, key: str = "row_id") -> DataFrame:
    """Results carry ``row_id``; order is imposed only at the sink."""
    return df.orderBy(key)
