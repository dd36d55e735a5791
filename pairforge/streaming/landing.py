"""The row-local operators over a JSONL landing folder (Structured Streaming).

Scored candidate sets (or log-prob rows) land as JSONL files.  Pair selection
and the row-local losses need no state, so the same plans run unchanged on
the stream and write through the file sink (exactly-once via its commit log).
The run record (mean / top-1 score per micro-batch, S6) is written by
``foreachBatch``, one folder per epoch, so a replayed epoch overwrites rather
than duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.pairs import build_pairs
from ..operators.summaries import score_summary
from ..schemas import SCORED
from ..session import shared_dir


def read_landing(spark: SparkSession, landing: str, schema: StructType = SCORED,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming S1: typed JSONL files as they arrive; a malformed line fails the query."""
    reader = spark.readStream.schema(schema).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(landing)


def stream_pairs(spark: SparkSession, landing: str, out: str, choose_type: str,
                 checkpoint: str | None = None, available_now: bool = True,
                 fmt: str = "parquet", **pair_args) -> StreamingQuery:
    """Pairs from every landed scored row, appended to ``out`` (file sink)."""
    pairs = build_pairs(read_landing(spark, landing), choose_type, **pair_args)
    ckpt = checkpoint or shared_dir(spark, "streams", "pairs", unique=True)
    writer = pairs.writeStream.format(fmt).outputMode("append").option("path", out) \
        .option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def stream_losses(spark: SparkSession, landing: str, out: str, loss_type: str,
                  checkpoint: str | None = None, available_now: bool = True, fmt: str = "parquet",
                  **loss_args) -> StreamingQuery:
    """Row-local preference losses (every type but bco_pair / aot / aot_pair, which
    need whole batches) over landed log-prob rows, appended to ``out``."""
    from ..operators.losses import preference_loss
    from ..schemas import LOGPS

    if loss_type in ("bco_pair", "aot", "aot_pair"):
        raise ValueError(f"{loss_type} needs whole batches; run it on the landed table instead")
    losses = preference_loss(read_landing(spark, landing, LOGPS), loss_type, **loss_args)
    ckpt = checkpoint or shared_dir(spark, "streams", "losses", unique=True)
    writer = losses.writeStream.format(fmt).outputMode("append").option("path", out) \
        .option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def stream_run_records(spark: SparkSession, landing: str, record: str, k: int,
                       checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Per micro-batch score summary (A1-A3) written to ``record/epoch=<id>``."""

    def sink(batch: DataFrame, epoch_id: int) -> None:
        summary = score_summary(batch, k).withColumn("epoch", F.lit(epoch_id))
        summary.write.mode("overwrite").option("sep", "\t").csv(f"{record}/epoch={epoch_id}")

    ckpt = checkpoint or shared_dir(spark, "streams", "records", unique=True)
    writer = read_landing(spark, landing).writeStream.foreachBatch(sink).option("checkpointLocation", ckpt)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
