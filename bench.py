"""

Runs at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``
and prints ONE JSON line:
``{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}``.

Inputs are derived once and written to the shared folder, so that each timing
covers the operator, not the derivation.  Every timing executes the whole plan
through the ``noop`` sink (nothing is collected to the driver); each query is
run once to warm up and then ``BENCH_RUNS`` (default 3) times; the median counts.
log-probs.  With ``BENCH_SCALING=1`` the same bench also runs as subprocesses
added under ``"scaling"``.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from pairforge.functions.chat import END_OF_TURN, render_long  # noqa: E402
from pairforge.operators import losses as LS  # noqa: E402
from pairforge.operators import tokens as TK  # noqa: E402
from pairforge.operators.ordering import shard_cover, shard_floor, shard_round_robin, with_ordinal  # noqa: E402
from pairforge.operators.pairs import STRATEGIES, build_pairs  # noqa: E402
from pairforge.session import get_session, shared_dir  # noqa: E402
from pairforge.sources import fixtures as fx  # noqa: E402
from pairforge.sources.tables import read_table  # noqa: E402

REPLICATE = 100
SMALL_REPLICATE = 10  # losses, turns and ordinals: times the rows of the given tables


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, runs: int) -> float:
    fn()  # warm-up
    ts = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        ts.append(time.perf_counter() - t0)
    return statistics.median(ts)


def replicate(df: DataFrame, key: str, times: int, *more: str) -> DataFrame:
    """x``times`` copies with fresh unique keys (row-local explode, no join); ``more`` keys become fresh alike."""
    return df.select(F.explode(F.sequence(F.lit(0), F.lit(times - 1))).alias("_rep"), "*") \
        .withColumns({k: F.col(k) * times + F.col("_rep") for k in (key, *more)}).drop("_rep")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = get_session()
    base = shared_dir(spark, "bench", unique=True)

    cpus = int(os.environ.get("BENCH_CPUS", "8"))

    def stage(df: DataFrame, name: str) -> DataFrame:
        # a multi-file table, as real inputs are: one file per slot, round-robin
        path = f"{base}/{name}"
        df.repartition(2 * cpus).write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    scored = stage(replicate(fx.scored(spark, sf_dir), "row_id", REPLICATE), "scored_x100")
    logps = stage(replicate(fx.logps(spark, sf_dir), "pair_id", SMALL_REPLICATE, "batch_id"), "logps_x10")
    tokens = stage(replicate(fx.tokens(spark, sf_dir), "seq_id", REPLICATE), "tokens_x100")
    conv = stage(replicate(read_table(spark, sf_dir, "conversations"), "conv_id", SMALL_REPLICATE), "turns_x10") \
        .withColumnsRenamed({"conv_id": "row_id", "text": "content"})
    orders = stage(replicate(read_table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", SMALL_REPLICATE), "orders_x10")

    rows = {
        "scored": scored.count(), "logps": logps.count(), "tokens": tokens.count(),
        "turns": conv.count(), "orders": orders.count(),
    }

    plans = {}
    for s in STRATEGIES:
        lam = 1.0 / 256 if s == "max_min_p" else 0.0
        plans[f"pairs_{s}"] = ("scored", lambda s=s, lam=lam: build_pairs(scored, s, length_penalty=lam,
                                                                          eot_token=END_OF_TURN))
    plans["render_chat"] = ("turns", lambda: render_long(conv))
    for t in LS.LOSS_TYPES:
        plans[f"loss_{t}"] = ("logps", lambda t=t: LS.preference_loss(logps, t, beta=0.1))
    plans["seq_logps"] = ("tokens", lambda: TK.sequence_logps(tokens))
    plans["ordinal"] = ("orders", lambda: with_ordinal(orders, key="o_orderkey"))
    plans["shards"] = ("orders", lambda: shard_cover(orders, 7, key="o_orderkey")
                       .unionByName(shard_floor(orders, 7, drop_tail=True, key="o_orderkey"))
                       .unionByName(shard_round_robin(orders, 7, key="o_orderkey")))

    secs, rps = {}, {}
    for name, (rows_key, build) in plans.items():
        secs[name] = round(timed(lambda b=build: run(b()), runs), 4)
        rps[name] = round(rows[rows_key] / secs[name], 1) if secs[name] > 0 else None

    scaling = {}
    if os.environ.get("BENCH_SCALING") == "1":
        import subprocess

        spark.stop()
        for c in (1, 4):
            env = {**os.environ, "BENCH_CPUS": str(c), "BENCH_SCALING": "0"}
            out = subprocess.run([sys.executable, os.path.abspath(__file__)], env=env, capture_output=True,
                                 text=True, check=True).stdout.strip().splitlines()[-1]
            scaling[str(c)] = json.loads(out)["queries"]

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(secs.values()), 4),
        "unit": "sec",
        "queries": secs,
        "rows_per_sec": rps,
        "input_rows": rows,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
        **({"scaling": scaling} if scaling else {}),
    }))


if __name__ == "__main__":
    main()
