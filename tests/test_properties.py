"""Hypothesis properties, each example checked in one Spark job."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pairforge.functions.text import PY_WHITESPACE, py_strip
from pairforge.operators.tokens import pack_spans

FAST = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
ALPHABET = st.sampled_from(list(PY_WHITESPACE) + list("ab é😀​﻿_<|>"))


@FAST
@given(st.lists(st.text(alphabet=ALPHABET, max_size=12), min_size=1, max_size=40))
def test_py_strip_equals_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    got = {r.i: r.s for r in df.select("i", py_strip("t").alias("s")).collect()}
    assert [got[i] for i in range(len(texts))] == [t.strip() for t in texts]


@FAST
@given(st.lists(st.integers(min_value=0, max_value=30), min_size=1, max_size=60), st.integers(min_value=1, max_value=16))
def test_pack_spans_equals_brute_force(spark, counts, block):
    df = spark.createDataFrame([(i * 3 + 1, n) for i, n in enumerate(counts)], "doc_id long, n_tokens long")
    got = sorted(tuple(r) for r in pack_spans(df, block).collect())
    exp, pos = [], 0
    for i, n in enumerate(counts):
        for t in range(n):
            b, off = divmod(pos + t, block)
            if t == 0 or off == 0:
                exp.append([b, i * 3 + 1, off, t, 0])
            exp[-1][4] += 1
        pos += n
    assert got == sorted(tuple(x) for x in exp)


def _expected_pair(rewards, responses, strategy, lam):
    import math

    import numpy as np

    def missing(x):
        return x is None or (isinstance(x, float) and math.isnan(x))

    if len(rewards) < 2:
        return None
    if strategy == "random":
        i0, i1 = 0, 1
        if missing(rewards[0]) or missing(rewards[1]):
            return None
    else:
        if any(missing(x) for x in rewards):
            return None
        r = np.array(rewards, dtype=float)
        if strategy == "max_random":
            i0 = int(np.argmax(r))
            i1 = 1 if i0 == 0 else 0
        elif strategy == "max_min":
            i0, i1 = int(np.argmax(r)), int(np.argmin(r))
        elif strategy == "max_max":
            s = np.argsort(r, kind="stable")
            i0, i1 = int(s[-1]), int(s[-2])
        else:
            p = np.array([x - lam * len(t) for x, t in zip(rewards, responses)])
            i0, i1 = int(np.argmax(p)), int(np.argmin(p))
    r0, r1 = rewards[i0], rewards[i1]
    if r0 > r1:
        return responses[i0], responses[i1], r0 - r1
    if r0 < r1:
        return responses[i1], responses[i0], r1 - r0
    return None


REWARD = st.one_of(st.sampled_from([-1.0, 0.0, 0.5, 1.0, 2.0]), st.just(float("nan")), st.none())


@FAST
@given(st.lists(st.tuples(st.lists(REWARD, max_size=6), st.integers(min_value=0, max_value=9)), min_size=1, max_size=40))
def test_build_pairs_equals_brute_force(spark, rows):
    from helpers import scored_rows
    from pairforge.operators.pairs import STRATEGIES, build_pairs

    data = []
    for i, (rewards, seed) in enumerate(rows):
        responses = [f"r{i}_{j}_" + "x" * ((seed * (j + 3)) % 11) for j in range(len(rewards))]
        data.append((i, rewards, responses))
    df = scored_rows(spark, data)
    for s in STRATEGIES:
        lam = 0.25 if s == "max_min_p" else 0.0
        got = {r.row_id: (r.chosen, r.rejected, r.margin) for r in build_pairs(df, s, length_penalty=lam).collect()}
        exp = {}
        for i, rewards, responses in data:
            e = _expected_pair(rewards, responses, s, lam)
            if e is not None:
                exp[i] = e
        assert got == exp, s


LOGP = st.floats(min_value=-200.0, max_value=0.0, allow_nan=False)


@FAST
@given(st.lists(st.tuples(LOGP, LOGP, LOGP, LOGP), min_size=1, max_size=30),
       st.sampled_from([0.05, 0.1, 0.5, 2.0]), st.sampled_from([0.0, 0.1, 0.3]))
def test_row_losses_equal_formulas(spark, rows, beta, eps):
    import math

    from helpers import logps_rows
    from pairforge.operators.losses import preference_loss

    def ls(x):
        return min(x, 0.0) - math.log1p(math.exp(-abs(x)))

    def sig(x):
        return 1 / (1 + math.exp(-x)) if x >= 0 else math.exp(x) / (1 + math.exp(x))

    df = logps_rows(spark, [(i, 0, *r) for i, r in enumerate(rows)])
    for lt in ("sigmoid", "robust", "exo_pair", "hinge", "ipo", "sppo_hard", "nca_pair", "apo_zero", "apo_down"):
        got = {r.pair_id: r.loss for r in preference_loss(df, lt, beta=beta, label_smoothing=eps).collect()}
        for i, (pc, pr, rc, rr) in enumerate(rows):
            w, l = pc - rc, pr - rr
            z = (pc - pr) - (rc - rr)
            bz = beta * z
            e = eps if eps else 1e-3
            exp = {
                "sigmoid": -ls(bz) * (1 - eps) - ls(-bz) * eps,
                "robust": (-ls(bz) * (1 - eps) + ls(-bz) * eps) / (1 - 2 * eps),
                "exo_pair": sig(bz) * (ls(bz) - math.log(1 - e)) + sig(-bz) * (ls(-bz) - math.log(e)),
                "hinge": max(0.0, 1 - bz),
                "ipo": (z - 1 / (2 * beta)) ** 2,
                "sppo_hard": (w - 0.5 / beta) ** 2 + (l + 0.5 / beta) ** 2,
                "nca_pair": -ls(beta * w) - 0.5 * ls(-beta * w) - 0.5 * ls(-beta * l),
                "apo_zero": 1 - sig(beta * w) + sig(beta * l),
                "apo_down": sig(beta * w) + 1 - sig(beta * (w - l)),
            }[lt]
            assert math.isclose(got[i], exp, rel_tol=1e-9, abs_tol=1e-9), (lt, got[i], exp)
