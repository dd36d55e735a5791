"""Ordinals, prefix sums, shards and shuffle."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from pairforge.operators.ordering import (head_n, range_scan, shard_cover,
                                          shard_floor, shard_round_robin, shuffle, with_ordinal)


def keyed(spark, keys):
    return spark.createDataFrame([(k, (k * 7) % 13) for k in keys], "row_id long, v long")


def test_ordinal_sparse_negative_keys(spark):
    rng = random.Random(5)
    keys = rng.sample(range(-(2**40), 2**40), 3000)
    out = with_ordinal(keyed(spark, keys)).toPandas().sort_values("row_id")
    assert list(out["ordinal"]) == list(range(len(keys)))


def test_running_sums_over_sparse_keys(spark):
    rng = random.Random(11)
    keys = sorted(rng.sample(range(0, 2**50), 2000))
    df = keyed(spark, keys)
    got = range_scan(df, ["row_id"], sums=["v"]).toPandas().sort_values("row_id")
    pdf = pd.DataFrame({"row_id": keys, "v": [(k * 7) % 13 for k in keys]})
    assert list(got["v_before"]) == list(pdf["v"].cumsum() - pdf["v"])
    assert list(got["_pos"]) == list(range(2000))


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_segments_that_fill_many_ranges(spark, partitions):
    """A segment with most rows, segments of one row, repeated keys, both signs of 64 bits."""
    rng = random.Random(partitions)
    groups = [-(1 << 63)] * 3 + [5] * 700 + list(range(6, 40)) + [(1 << 63) - 1] * 200
    rows = [(g, rng.randrange(50), float(rng.randrange(-8, 9)) / 4, rng.randrange(9)) for g in groups]
    df = spark.createDataFrame(rows, "g long, k long, x double, n long").repartition(7)
    got = range_scan(df, ["g", "k", "x", "n"], sums=["x", "n"], segment=["g"], partitions=partitions).collect()
    want = sorted(rows)
    assert sorted((r.g, r.k, r.x, r.n) for r in got) == want
    first = {}
    for at, r in enumerate(want):
        first.setdefault(r[0], at)
    for at, r in enumerate(sorted(got, key=lambda r: r["_pos"])):
        assert (r["_pos"], r.g, r["_start"]) == (at, want[at][0], first[r.g])
        assert r.x_before == sum(w[2] for w in want[:at]) and r.n_before == sum(w[3] for w in want[:at])


def test_scan_of_an_empty_table_and_of_null_summands(spark):
    df = keyed(spark, range(4))
    assert range_scan(df.where("false"), ["row_id"], sums=["v"], segment=["row_id"]).collect() == []
    with pytest.raises(Exception, match="must not be null"):
        range_scan(df.withColumn("v", F.when(F.col("row_id") != 2, F.col("v"))), ["row_id"], sums=["v"]).collect()


def test_shard_floor_drops_tail(spark):
    n, w = 103, 7
    out = shard_floor(keyed(spark, range(n)), w, drop_tail=True).toPandas()
    assert len(out) == n - n % w
    assert set(out["shard"]) == set(range(w))
    assert out.groupby("shard").size().eq(n // w).all()


def test_shard_floor_small_input(spark):
    assert shard_floor(keyed(spark, range(3)), 7, drop_tail=True).count() == 0
    assert shard_floor(keyed(spark, range(3)), 7, drop_tail=False).count() == 3


def test_shard_cover_partitions_exactly(spark):
    n, w = 103, 7
    out = shard_cover(keyed(spark, range(n)), w).toPandas()
    assert len(out) == n and out["row_id"].is_unique
    share = n // w + 1
    assert (out["shard"] == out["ordinal"] // share).all()


def test_round_robin(spark):
    out = shard_round_robin(keyed(spark, range(0, 50, 2)), 4).toPandas()
    assert (out["shard"] == out["ordinal"] % 4).all()


def test_shuffle_is_a_repeatable_permutation(spark):
    df = keyed(spark, range(500))
    a = shuffle(df, 42).toPandas().sort_values("row_id")
    b = shuffle(df.repartition(7), 42).toPandas().sort_values("row_id")
    assert sorted(a["position"]) == list(range(500))
    assert list(a["position"]) == list(b["position"])
    c = shuffle(df, 43).toPandas().sort_values("row_id")
    assert list(a["position"]) != list(c["position"])


def test_head_n(spark):
    df = keyed(spark, [5, 3, 9, 1])
    assert [r.row_id for r in head_n(df, 2).collect()] == [1, 3]
    assert head_n(df, 0).count() == 4


def test_ordinal_with_hot_duplicate_key(spark):
    # a third of the rows share one key
    keys = [7] * 200 + list(range(100, 500))
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "row_id long, v long")
    out = with_ordinal(df).toPandas()
    assert sorted(out["ordinal"]) == list(range(len(keys)))
    by_key = out.sort_values("ordinal")["row_id"].tolist()
    assert by_key == sorted(keys)
    same = with_ordinal(df, tiebreak=["v"]).toPandas().sort_values("ordinal")
    assert same[same.row_id == 7]["v"].tolist() == list(range(200))


def test_no_data_sized_single_partition_exchange(spark):
    from pyspark.sql import functions as F

    from helpers import single_partition_shuffle_records
    from pairforge.operators.losses import bco_running_delta
    from pairforge.operators.tokens import pack_spans

    n = 200_000
    dense = spark.range(0, n).withColumnRenamed("id", "row_id")
    sparse = spark.range(0, n).select((F.col("id") * 7919 + 13).alias("row_id"))
    docs = spark.range(0, n).select(F.col("id").alias("doc_id"), (F.col("id") % 17).alias("n_tokens"))
    batches = spark.range(0, n).select(F.col("id").alias("pair_id"), F.col("id").alias("batch_id"),
                                       *[(-(F.col("id") % 7)).cast("double").alias(c) for c in (
                                           "policy_chosen_logps", "policy_rejected_logps",
                                           "reference_chosen_logps", "reference_rejected_logps")])
    for df in (with_ordinal(dense), with_ordinal(sparse), pack_spans(docs, 64), bco_running_delta(batches)):
        recs = single_partition_shuffle_records(df)
        assert all(r <= 2 ** 16 for r in recs), recs
