"""Session helpers.

``get_session`` is for local runs and tests; on a cluster the caller owns the
session and only ``shared_dir`` is used.  ``shared_dir`` reads the cluster's
``spark.checkpoint.dir``; without one it sets a local folder where the master is
local (tests, laptops) and is an error anywhere else.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "pairforge") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    parts = shuffle_partitions or int(os.environ.get("PAIRFORGE_SHUFFLE_PARTITIONS", "8"))
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PAIRFORGE_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A folder under the cluster-wide checkpoint directory.

    Uses the session's checkpoint directory (``spark.checkpoint.dir``).  Without
    one, a local master gets a fresh local folder, as in tests; on a cluster
    executors wouldn't share it, so that is an error.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if base is None:
        conf = spark.conf.get("spark.checkpoint.dir", None)
        if not conf:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            conf = tempfile.mkdtemp(prefix="pairforge-ckpt-")
        sc.setCheckpointDir(conf)
        base = sc.getCheckpointDir()
    path = base.rstrip("/")
    for p in parts:
        path = f"{path}/{p}"
    if unique:
        path = f"{path}/{uuid.uuid4().hex}"
    return path
