"""Reading the input tables.  Parquet scans get column pruning and filter
pushdown from Catalyst; callers select only the columns they use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def read_prompts(spark: SparkSession, path: str, key: str = "context_messages",
                 fmt: str = "parquet") -> DataFrame:
    """A prompt table (local path or catalog table) with the message list under ``key``."""
    if fmt == "table":
        df = spark.table(path)
    else:
        df = spark.read.format(fmt).load(path)
    return df.select("row_id", df[key].alias("context_messages"))
