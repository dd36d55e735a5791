"""Three iterations of render -> generate -> score -> pairs over the test data
(what the reference's shell loop does), with the deterministic stand-in hooks.

    python examples/iterate.py [sf_dir]

Replace ``generator_for`` / ``md5_scorer`` with real model hooks (and
``generator_setup`` / ``scorer_setup`` in the config to load the models once
per Python worker).  Stage tables land under the session's checkpoint folder.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from pairforge.operators.ordering import shard_cover  # noqa: E402
from pairforge.plans.iteration import IterationConfig, run_iterations  # noqa: E402
from pairforge.plans.stand_ins import echo_generator, md5_scorer  # noqa: E402
from pairforge.session import get_session, shared_dir  # noqa: E402
from pairforge.sources import fixtures  # noqa: E402
from pairforge.sources.jsonl import read_records  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session()
    prompts = shard_cover(fixtures.prompts(spark, sf_dir), 3)  # one prompt set per iteration
    record = shared_dir(spark, "example_records", unique=True)
    cfg = IterationConfig(k=4, choose_type="max_min", eot_token="<|eot_id|>", max_input_length=3000,
                          record_path=record, stage_format="json",
                          generator_setup=lambda i: lambda: f"iter{i} ")  # iteration i's own model

    pairs = run_iterations(spark, cfg, lambda i: prompts.filter(F.col("shard") == i - 1).drop("shard", "ordinal"),
                           lambda i: echo_generator, md5_scorer, iterations=3)
    pairs.groupBy("iteration").agg(F.count(F.lit(1)).alias("pairs"), F.avg("margin").alias("mean_margin")) \
        .orderBy("iteration").show()
    read_records(spark, record).orderBy("iteration").show()


if __name__ == "__main__":
    main()
