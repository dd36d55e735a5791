"""Pair selection: hand-written edge rows (FIXTURES part 3) and properties."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import scored_rows
from pairforge.functions.arrays import argmax_first, argmin_first, argsort_last_two, has_missing
from pairforge.operators.pairs import STRATEGIES, build_pairs, build_pairs_multi, best_vs_rest, pair_outcomes

NAN = float("nan")


def pairs_by_id(df):
    return {r.row_id: r for r in df.collect()}


def outcomes(spark, rows, strategy, lam=0.0):
    out = pair_outcomes(scored_rows(spark, rows), strategies=(strategy,), length_penalty=lam).collect()
    return {r.outcome: r.n for r in out}


def test_nan_rows(spark):
    rows = [(1, [1.0, NAN, 3.0], None), (2, [3.0, 1.0, NAN], None)]
    df = scored_rows(spark, rows)
    for s in ("max_random", "max_min", "max_max"):
        assert build_pairs(df, s).count() == 0, s
    assert build_pairs(df, "max_min_p", length_penalty=0.5).count() == 0
    kept = pairs_by_id(build_pairs(df, "random"))
    assert set(kept) == {2}
    assert kept[2].chosen == "resp2_0" and kept[2].rejected == "resp2_1" and kept[2].margin == 2.0


def test_null_reward_counts_as_nan(spark):
    rows = [(1, [1.0, None, 3.0], None)]
    assert outcomes(spark, rows, "max_min") == {"nan": 1}
    assert outcomes(spark, [(1, [None, 1.0], None)], "random") == {"nan": 1}


def test_short_rows(spark):
    rows = [(1, [], []), (2, [1.0], None)]
    for s in STRATEGIES:
        assert build_pairs(scored_rows(spark, rows), s).count() == 0
        assert outcomes(spark, rows, s) == {"short": 2}
    with pytest.raises(Exception):
        build_pairs(scored_rows(spark, rows), "max_min", strict=True).collect()


def test_all_equal_dropped(spark):
    rows = [(1, [2.0, 2.0, 2.0, 2.0], ["a", "bb", "ccc", "dddd"])]
    for s in STRATEGIES:
        lam = 0.25 if s == "max_min_p" else 0.0
        assert build_pairs(scored_rows(spark, rows), s, length_penalty=lam).count() == 0, s


def test_max_max_second_place_tie(spark):
    r = pairs_by_id(build_pairs(scored_rows(spark, [(1, [5.0, 3.0, 3.0, 1.0], None)]), "max_max"))[1]
    assert r.chosen == "resp1_0" and r.rejected == "resp1_2" and r.margin == 2.0


def test_top_tie(spark):
    df = scored_rows(spark, [(1, [5.0, 5.0, 1.0], None)])
    r = pairs_by_id(build_pairs(df, "max_min"))[1]
    assert r.chosen == "resp1_0" and r.rejected == "resp1_2"
    assert build_pairs(df, "max_max").count() == 0
    assert build_pairs(df, "max_random").count() == 0


def test_max_min_p_orients_on_raw_rewards(spark):
    # penalised: [1 - 8*0.25, 0.5 - 0] = [-1, 0.5] -> argmax 1, argmin 0; raw 1 > 0.5 -> index 0 chosen
    df = scored_rows(spark, [(1, [1.0, 0.5], ["x" * 8, ""])])
    r = pairs_by_id(build_pairs(df, "max_min_p", length_penalty=0.25, margin_scale=2.0))[1]
    assert r.chosen == "x" * 8 and r.rejected == "" and r.margin == 1.0


def test_eot_and_prompt_rendering(spark):
    df = scored_rows(spark, [(7, [0.0, 1.0], ["a", "b"])])
    r = pairs_by_id(build_pairs(df, "random", eot_token="<E>"))[7]
    assert r.chosen == "b<E>" and r.rejected == "a<E>"
    assert r.prompt == ("<|begin_of_text|><|start_header_id|>user<|end_header_id|>\n\nquestion 7<|eot_id|>"
                        "<|start_header_id|>assistant<|end_header_id|>\n\n")


def test_unknown_strategy():
    from pairforge.operators.pairs import select_indices
    with pytest.raises(ValueError):
        select_indices("best", F.col("r"), F.col("t"))


def test_index_functions_match_numpy(spark):
    rng = random.Random(7)
    arrays = [[rng.choice([-1.0, 0.0, 0.5, 1.0, 2.0]) for _ in range(rng.randint(2, 7))] for _ in range(400)]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "id long, r array<double>")
    i0, i1 = argsort_last_two("r")
    got = {x.id: x for x in df.select("id", argmax_first("r").alias("mx"), argmin_first("r").alias("mn"),
                                      i0.alias("s0"), i1.alias("s1"), has_missing("r").alias("m")).collect()}
    for i, a in enumerate(arrays):
        order = np.argsort(np.array(a), kind="stable")
        g = got[i]
        assert g.mx == int(np.argmax(a)) and g.mn == int(np.argmin(a))
        assert (g.s0, g.s1) == (int(order[-1]), int(order[-2]))
        assert g.m is False


def test_has_missing(spark):
    df = spark.createDataFrame([([1.0, None],), ([NAN, 1.0],), ([1.0],), ([],)], "r array<double>")
    assert [x.m for x in df.select(has_missing("r").alias("m")).collect()] == [True, True, False, False]


def test_chosen_beats_rejected_and_accounting(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        n = rng.randint(0, 6)
        rows.append((i, [rng.choice([0.0, 0.25, 1.0, 1.5, NAN]) if rng.random() < 0.1 else rng.choice([0.0, 0.25, 1.0])
                         for _ in range(n)], None))
    df = scored_rows(spark, rows)
    rewards = {rid: r for rid, r, _ in rows}
    for s in STRATEGIES:
        lam = 0.125 if s == "max_min_p" else 0.0
        pairs = build_pairs(df, s, length_penalty=lam).collect()
        for p in pairs:
            ci = int(p.chosen.split("_")[1])
            ri = int(p.rejected.split("_")[1])
            assert rewards[p.row_id][ci] > rewards[p.row_id][ri]
            assert p.margin > 0
        counts = {x.outcome: x.n for x in pair_outcomes(df, (s,), length_penalty=lam).collect()}
        assert sum(counts.values()) == len(rows)
        assert counts.get("kept", 0) == len(pairs)


def test_same_result_under_repartitioning(spark):
    rows = [(i, [float(i % 5), float(i % 3), 1.0], None) for i in range(200)]
    df = scored_rows(spark, rows)
    base = sorted(map(tuple, build_pairs(df, "max_min").collect()))
    for n in (1, 4, 17):
        assert sorted(map(tuple, build_pairs(df.repartition(n), "max_min").collect())) == base


def test_multi_pairs_no_orientation(spark):
    df = scored_rows(spark, [(1, [1.0, 3.0, 3.0], None)])
    out = sorted(build_pairs_multi(df, best_vs_rest).collect(), key=lambda r: r.pair_idx)
    assert [(r.chosen, r.rejected, r.margin) for r in out] == [("resp1_1", "resp1_0", 2.0), ("resp1_1", "resp1_2", 0.0)]


def test_multi_pairs_unequal_lists_raise(spark):
    df = scored_rows(spark, [(1, [1.0, 3.0], None)])
    with pytest.raises(Exception):
        build_pairs_multi(df, lambda r, t: (F.array(F.lit(0)), F.array(F.lit(0), F.lit(1)))).collect()


def test_pairs_plan_is_row_local(spark):
    df = scored_rows(spark, [(1, [1.0, 2.0], None)])
    for s in STRATEGIES:
        plan = build_pairs(df, s, length_penalty=0.1 if s == "max_min_p" else 0.0)._jdf.queryExecution() \
            .executedPlan().toString()
        assert "Exchange" not in plan and "Python" not in plan and "ArrowEval" not in plan, s


def test_log2_guard():
    assert math.isclose(math.log(2), 0.6931471805599453)
