"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

#: Rows of one Arrow batch.  Whole texts travel in batches, so the row count bounds a worker's memory.
BATCH_ROWS = 256
#: A side of a join is broadcast only when a count shows at most this many (id, flag) rows: about 64 MB as a hash table.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lower the session's Arrow batch size to ``rows`` (never raises it)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage: the rows are written once to the shared checkpoint folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written_by(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """As ``written``, dealt out by a hash of ``key``.  The copy keeps that partitioning, so a later grouping by ``key`` doesn't
    move its rows again; that takes a plan that isn't re-planned while it runs."""
    conf, name = df.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        return written(df.repartition(max(partitions, int(conf.get("spark.sql.shuffle.partitions"))), key))
    finally:
        conf.set(name, before)


def held_out(doc_id: Column) -> Column:
    """True where crc32(doc_id as text) mod 3 is 1; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def keep_ids(df: DataFrame, ids: DataFrame, key: str, how: str) -> DataFrame:
    """``left_semi`` or ``left_anti`` join of wide rows with an id list; the list is
    broadcast behind a count, and beyond ``BROADCAST_ROWS`` both sides are shuffled."""
    ids = written(ids.select(key).where(F.col(key).isNotNull()).distinct())
    side = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids.hint("shuffle_merge")
    return df.join(side, key, how)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front as long as a column is called that."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
