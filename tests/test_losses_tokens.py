"""Preference losses (Z*, X*) and token reductions (T*), against direct formulas."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import logps_rows
from pairforge.operators import losses as LS
from pairforge.operators import tokens as TK
from pairforge.schemas import TOKENS


def losses(spark, rows, loss_type, **kw):
    return {r.pair_id: r for r in LS.preference_loss(logps_rows(spark, rows), loss_type, **kw).collect()}


def test_sigmoid_zero_is_ln2(spark):
    out = losses(spark, [(1, 0, 0.0, 0.0, 0.0, 0.0)], "sigmoid", beta=0.1)
    assert math.isclose(out[1].loss, math.log(2), rel_tol=1e-12)
    assert out[1].chosen_reward == 0.0 and out[1].rejected_reward == 0.0


def test_no_overflow_extreme_logits(spark):
    rows = [(1, 0, 10000.0, -10000.0, 0.0, 0.0), (2, 0, -10000.0, 10000.0, 0.0, 0.0)]
    for lt in ("sigmoid", "exo_pair", "robust", "apo_zero", "apo_down", "nca_pair"):
        for r in losses(spark, rows, lt, beta=1.0, label_smoothing=0.1 if lt == "robust" else 0.0).values():
            assert math.isfinite(r.loss), lt
    for r in losses(spark, rows, "sigmoid", beta=1.0, f_divergence="alpha_divergence").values():
        assert not math.isnan(r.loss)


def _ls(x):
    return min(x, 0) - math.log1p(math.exp(-abs(x)))


def _sig(x):
    return 1 / (1 + math.exp(-x))


def test_row_losses_against_formulas(spark):
    pc, pr, rc, rr, b = -3.0, -5.5, -4.0, -4.25, 0.2
    w, l = pc - rc, pr - rr
    z = (pc - pr) - (rc - rr)
    exp = {
        "sigmoid": -_ls(b * z),
        "hinge": max(0.0, 1 - b * z),
        "ipo": (z - 1 / (2 * b)) ** 2,
        "sppo_hard": (w - 0.5 / b) ** 2 + (l + 0.5 / b) ** 2,
        "nca_pair": -_ls(b * w) - 0.5 * _ls(-b * w) - 0.5 * _ls(-b * l),
        "apo_zero": 1 - _sig(b * w) + _sig(b * l),
        "apo_down": _sig(b * w) + 1 - _sig(b * (w - l)),
        "exo_pair": _sig(b * z) * (_ls(b * z) - math.log(1 - 1e-3)) + _sig(-b * z) * (_ls(-b * z) - math.log(1e-3)),
    }
    for lt, v in exp.items():
        got = losses(spark, [(1, 0, pc, pr, rc, rr)], lt, beta=b)[1].loss
        assert math.isclose(got, v, rel_tol=1e-12, abs_tol=1e-12), lt
    eps = 0.1
    rob = (-_ls(b * z) * (1 - eps) + _ls(-b * z) * eps) / (1 - 2 * eps)
    assert math.isclose(losses(spark, [(1, 0, pc, pr, rc, rr)], "robust", beta=b, label_smoothing=eps)[1].loss, rob)


def test_js_equals_reverse_kl_when_w_equals_l(spark):
    row = [(1, 0, -2.0, -3.0, -2.5, -3.5)]  # w = l = 0.5
    a = losses(spark, row, "sigmoid", f_divergence="js_divergence")[1].loss
    b = losses(spark, row, "sigmoid")[1].loss
    assert math.isclose(a, b, rel_tol=1e-12)


def test_reference_free_changes_only_the_logit(spark):
    row = [(1, 0, -2.0, -3.0, -2.5, -3.75)]
    r = losses(spark, row, "sigmoid", beta=0.5, reference_free=True)[1]
    assert math.isclose(r.loss, -_ls(0.5 * 1.0))
    assert math.isclose(r.chosen_reward, 0.5 * 0.5)


def test_aot_pair_equals_sigmoid_on_batch_of_one(spark):
    rows = [(i, i, -float(i % 5), -float(i % 3) - 1, -1.5, -2.0) for i in range(6)]
    df = logps_rows(spark, rows)
    sig = {r.batch_id: r.loss for r in LS.preference_loss(df, "sigmoid").collect()}
    aot = {r.batch_id: r.loss for r in LS.preference_loss(df, "aot_pair").collect()}
    for k in sig:
        assert math.isclose(sig[k], aot[k], rel_tol=1e-12)


def test_aot_sorts_within_batch(spark):
    rows = [(1, 0, -1.0, -4.0, -2.0, -2.0), (2, 0, -3.0, -1.0, -2.0, -2.0), (3, 0, -2.0, -2.0, -2.0, -2.0)]
    out = sorted(LS.preference_loss(logps_rows(spark, rows), "aot_pair", beta=1.0).collect(), key=lambda r: r.rank)
    a = sorted(r[2] - r[4] for r in rows)
    c = sorted(r[3] - r[5] for r in rows)
    for r, (x, y) in zip(out, zip(a, c)):
        assert math.isclose(r.loss, -_ls(x - y))


def test_bco_running_mean(spark):
    rows = [(i, i // 2, -float(i), -float(2 * i), -1.0, -1.0) for i in range(6)]
    out = losses(spark, rows, "bco_pair", beta=1.0)
    batch_means = []
    for b in range(3):
        vals = [(r[2] - r[4]) for r in rows if r[1] == b] + [(r[3] - r[5]) for r in rows if r[1] == b]
        batch_means.append(sum(vals) / len(vals))
    for pid, batch, pc, pr, rc, rr in rows:
        d = sum(batch_means[: batch + 1]) / (batch + 1)
        v = -_ls((pc - rc) - d) - _ls(-((pr - rr) - d))
        assert math.isclose(out[pid].loss, v, rel_tol=1e-12)


def test_validation():
    with pytest.raises(ValueError):
        LS._check("nope", "reverse_kl", 0.0, 0.1)
    with pytest.raises(ValueError):
        LS._check("robust", "reverse_kl", 0.5, 0.1)


def _tokens(spark, seqs):
    rows = []
    for sid, (labels, logits) in seqs.items():
        for p, (lab, lg) in enumerate(zip(labels, logits)):
            rows.append((sid, p, lab, [float(x) for x in lg]))
    return spark.createDataFrame(rows, TOKENS)


def test_sequence_logps_against_numpy(spark):
    rng = np.random.default_rng(1)
    seqs = {}
    for sid in range(4):
        L, V = 6, 5
        labels = [-100, -100] + list(rng.integers(0, V, L - 2))
        seqs[sid] = ([int(x) for x in labels], rng.normal(size=(L, V)).round(3).tolist())
    got = {r.seq_id: r for r in TK.sequence_logps(_tokens(spark, seqs)).collect()}
    for sid, (labels, logits) in seqs.items():
        lg = np.array(logits)[:-1]
        lab = np.array(labels)[1:]
        lsm = lg - (lg.max(axis=1, keepdims=True) + np.log(np.exp(lg - lg.max(axis=1, keepdims=True)).sum(axis=1, keepdims=True)))
        mask = lab != -100
        val = sum(lsm[i, lab[i]] for i in range(len(lab)) if mask[i])
        assert math.isclose(got[sid].logps, val, rel_tol=1e-9)
        assert got[sid].n_tokens == int(mask.sum())


def test_shape_check_raises(spark):
    labels = spark.createDataFrame([(1, 0, 1), (1, 1, 2)], "seq_id long, pos int, label int")
    logits = spark.createDataFrame([(1, 0, [0.0, 1.0, 2.0])], "seq_id long, pos int, logits array<double>")
    with pytest.raises(Exception):
        TK.check_shapes(labels, logits).collect()


def test_pack_neither_loses_nor_repeats(spark):
    counts = [0, 5, 3, 10, 1, 7, 0, 4]
    df = spark.createDataFrame([(i, [i * 100 + j for j in range(n)]) for i, n in enumerate(counts)],
                               "doc_id long, tokens array<long>")
    blocks = TK.pack_tokens(df, 4).orderBy("block_id").collect()
    flat = [t for b in blocks for t in b.tokens]
    assert flat == [i * 100 + j for i, n in enumerate(counts) for j in range(n)]
    assert all(len(b.tokens) == 4 for b in blocks[:-1])


def test_truncate_pair(spark):
    df = spark.createDataFrame([(list(range(10)), list(range(100, 106)), list(range(200, 203)))],
                               "p array<int>, c array<int>, r array<int>")
    p, c, r = TK.truncate_pair(F.col("p"), F.col("c"), F.col("r"), max_length=12, max_prompt_length=4)
    row = df.select(p.alias("p"), c.alias("c"), r.alias("r")).first()
    assert row.p == [6, 7, 8, 9] and row.c == list(range(100, 106)) and row.r == [200, 201, 202]
    p, c, r = TK.truncate_pair(F.col("p"), F.col("c"), F.col("r"), max_length=8, max_prompt_length=4)
    row = df.select(p.alias("p"), c.alias("c"), r.alias("r")).first()
    assert row.p == [6, 7, 8, 9] and row.c == [100, 101, 102, 103] and row.r == [200, 201, 202]


def test_rank_pairing_equals_sorting_each_batch(spark):
    import math
    import random
    rng = random.Random(9)
    # one hot batch holding most rows, plus small ones; ties included
    rows = [(i, 0 if i < 300 else 1 + i % 5, -float(rng.randint(0, 40)) / 8, -float(rng.randint(0, 40)) / 8,
             -float(rng.randint(0, 40)) / 8, -float(rng.randint(0, 40)) / 8) for i in range(400)]
    df = logps_rows(spark, rows)
    for lt in ("aot", "aot_pair"):
        want = []
        for b in {r[1] for r in rows}:
            own = [r[2:] for r in rows if r[1] == b]
            a = sorted(pc - rc if lt == "aot_pair" else pc - pr for pc, pr, rc, rr in own)
            c = sorted(pr - rr if lt == "aot_pair" else rc - rr for pc, pr, rc, rr in own)
            want += [(b, i, math.log1p(math.exp(-0.5 * (x - y)))) for i, (x, y) in enumerate(zip(a, c))]
        got = sorted(map(tuple, LS.rank_paired_loss(df, lt, beta=0.5).collect()))
        assert [g[:2] for g in got] == [w[:2] for w in sorted(want)]
        assert all(abs(g[2] - w[2]) < 1e-12 for g, w in zip(got, sorted(want)))


def test_truncate_pair_keep_start_and_validation(spark):
    df = spark.createDataFrame([(list(range(10)), list(range(100, 106)), list(range(200, 203)))],
                               "p array<int>, c array<int>, r array<int>")
    p, c, r = TK.truncate_pair(F.col("p"), F.col("c"), F.col("r"), max_length=12, max_prompt_length=4,
                               mode="keep_start")
    row = df.select(p.alias("p"), c.alias("c"), r.alias("r")).first()
    assert row.p == [0, 1, 2, 3] and row.c == list(range(100, 106))
    with pytest.raises(ValueError):
        TK.truncate_pair(F.col("p"), F.col("c"), F.col("r"), 12, 4, mode="middle")
