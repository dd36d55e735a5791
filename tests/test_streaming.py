"""Streaming pair selection equals the batch result on the same landed files."""

from helpers import scored_rows
from pairforge.operators.pairs import build_pairs
from pairforge.session import shared_dir
from pairforge.sources.jsonl import write_jsonl
from pairforge.streaming import stream_pairs, stream_run_records


def test_stream_matches_batch(spark):
    rows = [(i, [float(i % 4), float(i % 3), 0.5, float(i % 2)], None) for i in range(40)]
    df = scored_rows(spark, rows)
    landing = shared_dir(spark, "t_landing", unique=True)
    write_jsonl(df.filter("row_id < 20"), f"{landing}/a")
    write_jsonl(df.filter("row_id >= 20"), f"{landing}/b")
    out = shared_dir(spark, "t_stream_out", unique=True)
    q = stream_pairs(spark, f"{landing}/*", out, "max_min_p", length_penalty=1 / 64, eot_token="<E>")
    q.awaitTermination(120)
    got = sorted(map(tuple, spark.read.parquet(out).collect()))
    exp = sorted(map(tuple, build_pairs(df, "max_min_p", length_penalty=1 / 64, eot_token="<E>").collect()))
    assert got == exp and len(got) > 0

    record = shared_dir(spark, "t_stream_record", unique=True)
    r = stream_run_records(spark, f"{landing}/*", record, k=4)
    r.awaitTermination(120)
    lines = spark.read.option("sep", "\t").csv(record).collect()
    assert sum(int(x[0]) for x in lines) == 40


def test_stream_losses_rejects_batch_losses(spark):
    import pytest

    from pairforge.streaming import stream_losses
    for lt in ("bco_pair", "aot", "aot_pair"):
        with pytest.raises(ValueError):
            stream_losses(spark, "/nonexistent", "/nonexistent-out", lt)
