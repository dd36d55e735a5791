"""Hard-negative mining: packed products, bands, rounds and edge rows against plain Python."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairforge.llm import negatives
from pairforge.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.edge import rows_of, with_clashes

SCHEMA = "vec_id long, embedding array<float>, label int"
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def plain(rows, every=100, positives=5, negatives_=10):
    """rows: (id, vector, label) with the label already changed."""
    good = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((i, [math.floor(float(np.float32(x)) * 256.0) for x in v], label))
    anchors = {}
    for i, v, label in good:
        if i % every == 0 and (i not in anchors or (label, v) < anchors[i]):
            anchors[i] = (label, v)
    out = []
    for a, (label, q) in anchors.items():
        scored = [(min(max(sum(x * y for x, y in zip(q, v)), LOW), HIGH), i, lab) for i, v, lab in good if i != a and len(v) == len(q)]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for p, pid, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [s for s in scored if s[2] != label and 30 * p <= 100 * s[0] <= 90 * p][:negatives_]
            out += [(a, pid, r + 1, nid, p, n) for r, (n, nid, _) in enumerate(fits)]
    return sorted(out)


COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def mined(df, every=100, **more):
    got = negatives.mine_negatives(df, F.pmod("vec_id", F.lit(every)) == 0, F.col("label"), **more)
    return sorted(tuple(r[c] for c in COLUMNS) for r in got.collect())


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 6).flatmap(lambda d: st.tuples(
    st.lists(st.lists(st.integers(-(1 << 40), 1 << 40) | st.integers(-9, 9), min_size=d, max_size=d), min_size=1, max_size=9),
    st.lists(st.lists(st.integers(-300, 300), min_size=d, max_size=d), min_size=1, max_size=4))))
def test_packed_scores_are_exact(sets):
    x, q = (np.array(s, np.float64).reshape(len(s), len(s[0])) for s in sets)
    packed = negatives.Packed(x, q)
    want = [[sum(int(a) * int(b) for a, b in zip(r, c)) for c in x.tolist()] for r in q.tolist()]
    assert packed.scores(0, len(q)).tolist() == want


def test_fields_share_a_wide_integer_and_large_values_stay_exact():
    rng = np.random.default_rng(1)
    x, q = rng.integers(-40, 40, (1001, 16)).astype(float), rng.integers(-40, 40, (7, 16)).astype(float)
    packed = negatives.Packed(x, q)
    assert packed.fields >= 2 and packed.lanes == -(-1001 // packed.fields)
    assert (packed.scores(0, 7) == (q @ x.T).astype(int)).all()
    big = np.array([[2.0 ** 100, -(2.0 ** 100)], [3.0, 4.0], [2.0 ** 60, 0.0]])
    got = negatives.Packed(big, np.array([[1.0, 0.0], [2.0 ** 40, -1.0]])).scores(0, 2)
    assert got.tolist() == [[HIGH, 3, 1 << 60], [HIGH, 3 * (1 << 40) - 4, HIGH]]


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    want = plain([(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"]) for r in rows])
    got = sorted(tuple(r[c] for c in COLUMNS) for r in QUERIES["op12_hard_negatives"](spark, SF_SMALL).collect())
    assert got == want and len(got) > 50


@pytest.mark.parametrize("round_bytes", [1 << 24, 600])
def test_ties_repeats_nulls_widths_and_rounds(spark, monkeypatch, round_bytes):
    monkeypatch.setattr(negatives, "ROUND_BYTES", round_bytes)
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.integers(-2, 4, 3) / 8], int(rng.integers(0, 3))) for i in range(120)]
    rows += [(5, rows[5][1], rows[5][2]), (40, [1.0, 0.5, 0.25], 0), (40, [1.0, 0.5, 0.25], 0), (200, None, 1), (201, [0.1, None, 0.2], 1),
             (202, [float("nan"), 0.0, 1.0], 1), (203, [float("inf"), 0.0, 1.0], 1), (204, [0.5, 0.5], 1), (210, [0.75, 0.5], 1),
             (205, [0.5, 0.25], 2), (220, [], 1), (221, [], 1), (222, [], 2), (206, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1),
             (-30, [0.5, 0.5, 0.5], 1), (230, [3e37, 1.0, 1.0], 1), (231, [3e37, 1.0, 1.0], 1)]
    df = with_clashes(spark.createDataFrame(rows, SCHEMA), ["id", "score", "rank", "slot", "v", "anchor_id"])
    got = mined(df.repartition(5), every=10)
    assert got == plain(rows, every=10)
    assert any(p == 0 for *_, p, _ in got)


def test_parameters_and_empty_tables(spark):
    rows = [(i, [i / 64, 1.0], i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert mined(df, every=10, positives=2, negatives=3) == plain(rows, 10, 2, 3)
    assert mined(df.where("false")) == []
    assert rows_of(negatives.mine_negatives(df.where("label = 1 or vec_id = 0"), F.col("vec_id") == 0, F.col("label")), "anchor_id") == []
