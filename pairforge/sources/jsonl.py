"""JSONL sources and sinks (S1, S3-S6) and lineage cuts.

Rows are JSON lines with a fixed schema.  Reads fail fast on a malformed line
(Spark's default PERMISSIVE mode would turn it into a null row).  Writes keep
null fields and non-ASCII text as is.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import shared_dir


#: Splits whose byte counts are broadcast: about 150 bytes each, so 30 MB at most.
SPLITS_BROADCAST = 200_000


def read_jsonl(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str) -> DataFrame:
    """Typed JSONL read; a bad line fails the job."""
    p = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(p)


def add_row_ids(df: DataFrame, name: str = "row_id") -> DataFrame:
    """Give rows read from id-less files (the reference's JSONL) a dense ``row_id`` from 0, in file order.

    ``df`` must be the file scan itself.  Rows are ordered by file (shorter names
    first, so that shard 2 comes before shard 10), the split's start within the file,
    and the line within the split; Spark's own split order follows split sizes instead.
    """
    from ..operators.ordering import global_positions

    placed = df.select("*", F.length("_metadata.file_path").alias("_len"), F.col("_metadata.file_path").alias("_file"),
                       F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_line"))
    return global_positions(placed, ["_len", "_file", "_start", "_line"], name).drop("_len", "_file", "_start", "_line")


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``file, offset, value``: every line of the files with the byte at which it starts, however the files are split.

    Lines end at ``\\n`` only.  A first pass counts the bytes of each split's lines (one row per split); a second one runs
    over the splits in reading order and adds up within them.  No line is shuffled unless there are more than
    ``SPLITS_BROADCAST`` splits, whose counts are then joined instead of broadcast.  Compressed files count their
    uncompressed bytes.  Ids exist before anything is sorted, and a later line moves no earlier id.
    """
    p = [paths] if isinstance(paths, str) else list(paths)
    scan = spark.read.option("lineSep", "\n").text(p)
    lines = scan.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_start"), "value",
                        (F.octet_length("value") + F.lit(1)).cast("long").alias("_bytes"))
    before = Window.partitionBy("file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("file", "_start").agg(F.sum("_bytes").alias("_n")) \
        .select("file", "_start", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    splits = materialise(splits, shared_dir(spark, "line_splits", unique=True))
    side = F.broadcast(splits) if splits.count() <= SPLITS_BROADCAST else splits

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, upto = None, 0
        for batch in batches:
            file, start, value, n = (batch.column(c) for c in ("file", "_start", "value", "_bytes"))
            sizes, offsets = n.to_numpy(zero_copy_only=False), []
            for place, size in zip(zip(file.to_pylist(), start.to_pylist()), sizes.tolist()):
                if place != at:
                    at, upto = place, 0
                offsets.append(upto)
                upto += size
            yield pa.RecordBatch.from_arrays([file, start, value, pa.array(offsets, pa.int64())], ["file", "_start", "value", "_in"])

    placed = lines.mapInArrow(within, "file string, _start long, value string, _in long")
    return placed.join(side, ["file", "_start"]).select("file", (F.col("_base") + F.col("_in")).alias("offset"), "value")


def read_jsonl_at(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str) -> DataFrame:
    """S1 with ids: ``file, offset`` and the fields of every JSON line; blank lines give no row, a bad line fails the job."""
    lines = read_lines(spark, paths).where(F.trim("value", F.lit(" \t\r")) != "")
    return lines.select("file", "offset", F.from_json("value", schema, {"mode": "FAILFAST"}).alias("_row")).select("file", "offset", "_row.*")


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Whole-output overwrite; null fields kept."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_sharded(df: DataFrame, path: str, shard: str = "shard", mode: str = "overwrite") -> None:
    """One output folder per shard (``path/shard=i``), in one write job."""
    df.write.mode(mode).option("ignoreNullFields", "false").partitionBy(shard).json(path)


def read_shards(spark: SparkSession, path: str, n: int, schema: StructType | str,
                shard: str = "shard") -> DataFrame:
    """S3 + U1: the rows of shards 0..n-1 (UNION ALL semantics); the shard column is
    kept.  A shard that got no row has no folder, and adds nothing."""
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return rows.where(f"`{shard}` between 0 and {int(n) - 1}")


def _path(spark: SparkSession, path: str):
    """(Hadoop path, its file system)"""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def write_shard_files(df: DataFrame, base: str, n: int, shard: str = "shard") -> None:
    """S5 under the reference's names: shard i of 0..n-1 goes to ``base + i + ".json"``, empty shards too, replacing what is
    there.  One job reads ``df`` once and writes all shards; their folders then get their names.  Rows keep their
    order within a shard where ``df`` is sorted by (shard, ...) in its partitions."""
    spark = df.sparkSession
    landing = f"{base}-{uuid.uuid4().hex}"
    df.where(f"`{shard}` between 0 and {int(n) - 1}").withColumn("_shard", F.col(shard)).drop(shard) \
        .write.option("ignoreNullFields", "false").partitionBy("_shard").json(landing)
    for i in range(n):
        target, fs = _path(spark, f"{base}{i}.json")
        fs.delete(target, True)
        written = _path(spark, f"{landing}/_shard={i}")[0]
        if fs.exists(written):
            if not fs.rename(written, target):
                raise OSError(f"{written} could not be renamed to {target}")
        else:
            fs.mkdirs(target)
    landed, fs = _path(spark, landing)
    fs.delete(landed, True)


def write_in_order(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """L8 at a sink: files whose concatenation by name is in ``order``.  Rows are range-partitioned and sorted within
    ranges, so no task sorts the whole table; ``add_row_ids`` on the files gives every line its position."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_shard_files(spark: SparkSession, base: str, n: int, schema: StructType | str, shard: str = "shard") -> DataFrame:
    """S3 + U1 under the reference's names: ``base + i + ".json"`` for i in 0..n-1, with i in ``shard``.
    Files of other numbers are not read; a shard without a file adds nothing."""
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(f"{base}*.json")
    stem = base.rstrip("/").rsplit("/", 1)[-1]
    name = F.regexp_extract(F.col("_metadata.file_path"), rf"\Q{stem}\E(\d+)\.json", 1)
    return rows.withColumn(shard, name.try_cast("int")).where(f"`{shard}` between 0 and {int(n) - 1}")


RECORD_SCHEMA = "iteration long, mean_score double, top1_score double"


def write_record(df: DataFrame, path: str, iteration: int, run: str = "0") -> None:
    """The record lines (tab-separated) of one iteration, in a folder of their own under ``path``: a rerun replaces
    its iteration's lines and appends no second copy, and another ``run`` appends its own."""
    df.write.mode("overwrite").option("sep", "\t").csv(f"{path}/run={run}/{iteration}")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All record lines under ``path``, of all runs."""
    return spark.read.schema(RECORD_SCHEMA).option("sep", "\t").csv(f"{path}/run=*/*")


def _code(fn: object) -> object:
    """What a function does, as far as its code and constants tell."""
    code = getattr(fn, "__code__", fn)
    if not hasattr(code, "co_code"):
        return repr(code)
    return [code.co_code.hex(), list(code.co_names), [_code(c) for c in code.co_consts]]


def digest(*parts: object) -> str:
    """A digest of values, functions (code and closures), and digests."""
    def one(x: object) -> object:
        if callable(x):
            return [hashlib.sha256(cloudpickle.dumps(x)).hexdigest(), _code(x)]
        return x if isinstance(x, (str, int, float, bool, type(None))) else repr(x)

    return hashlib.sha256(json.dumps([one(p) for p in parts]).encode()).hexdigest()


def content_digest(df: DataFrame) -> str:
    """A digest of a table's rows, whatever their order or partitioning: one pass, one row back."""
    columns = [F.col(c) for c in df.columns]
    first, second = F.xxhash64(*columns), F.xxhash64(F.lit("second"), *columns)
    r = df.agg(F.count(F.lit(1)), F.sum(first.cast("decimal(38,0)")), F.bit_xor(first), F.sum(second.cast("decimal(38,0)"))).first()
    return digest(df.schema.json(), *map(str, r))


def _manifest(spark: SparkSession, path: str) -> str | None:
    """The digest noted for the stage at ``path``; null unless both the stage and the note are finished."""
    for done in (f"{path}/_SUCCESS", f"{path}.manifest/_SUCCESS"):
        p, fs = _path(spark, done)
        if not fs.exists(p):
            return None
    row = spark.read.text(f"{path}.manifest").first()
    return row[0] if row else None


def stage(df: DataFrame, path: str, fmt: str = "parquet", of: str | None = None) -> DataFrame:
    """``materialise``, unless the finished output at ``path`` was made of the same things.

    ``of`` is a digest of all that decides the stage's content (configuration, models, input; see ``digest`` and
    ``content_digest``).  It is noted beside the output once that is finished, and compared before reuse; without
    one, nothing is reused.  The note is voided before the output is replaced, so a run killed at any point leaves
    either a stage with its own note or one that is made again.
    """
    spark = df.sparkSession
    if of is None:
        return materialise(df, path, fmt)
    if _manifest(spark, path) == of:
        return read_jsonl(spark, path, df.schema) if fmt == "json" else spark.read.format(fmt).load(path)
    note = lambda text: spark.range(1, numPartitions=1).select(F.lit(text).alias("value")).write.mode("overwrite").text(f"{path}.manifest")
    note("unfinished")
    out = materialise(df, path, fmt)
    note(of)
    return out


def materialise(df: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Write a stage's output to the shared folder and read it back: cuts lineage,
    so a lost executor recomputes from this table, not from the first stage.
    ``fmt="json"`` writes JSONL (the reference's hand-off format) and reads it
    back with the written schema (no inference scan)."""
    if fmt == "json":
        write_jsonl(df, path)
        return read_jsonl(df.sparkSession, path, df.schema)
    df.write.mode("overwrite").format(fmt).save(path)
    return df.sparkSession.read.format(fmt).load(path)
