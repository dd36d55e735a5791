"""Mixing, the n-gram Jaccard join, fingerprints and the pipeline."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairforge.llm import fingerprints, mixing, ngram_join
from pairforge.llm.queries import QUERIES
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.edge import SCHEMA, edge_documents, rows_of, with_clashes


def documents(folder):
    return pq.read_table(f"{folder}/documents.parquet").to_pylist()


# --- mixing

def plain_targets(words, weights=(5, 2, 1), share=1.5):
    """Reshare the excess by weight until no target is above twice its source; sources in code point order, null last."""
    order = sorted(words, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped, budget = {}, share * sum(words.values())
    while True:
        free = [s for s in order if s not in capped]
        left = budget - sum(capped.values())
        target = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if target[s] > 2 * words[s]]
        if not over:
            return capped | target
        capped |= {s: 2.0 * words[s] for s in over}


def plain_size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_mix_query_meets_its_targets(spark):
    got = {r["doc_id"]: r for r in QUERIES["op3_mix"](spark, SF_ORACLE).collect()}
    docs = documents(SF_ORACLE)
    words = Counter()
    for d in docs:
        words[d["source"]] += plain_size(d["text"])
    want, taken = plain_targets(words), Counter()
    for d in docs:
        r = got[d["doc_id"]]
        assert r["size"] == plain_size(d["text"]) and r["source_size"] == words[d["source"]]
        assert r["target"] == pytest.approx(want[d["source"]], rel=1e-9)
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[d["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 60), st.integers(1, 4)), min_size=1, max_size=6, unique_by=lambda x: x[0]), st.floats(0, 2))
def test_knapsack_is_nearest(groups, part):
    sizes, counts = np.array([s for s, _ in groups]), np.array([c for _, c in groups])
    target = part * float((sizes * counts).sum())
    take = mixing.fit_budget(sizes, counts, target)
    assert ((0 <= take) & (take <= 2 * counts)).all()
    base = np.minimum(np.floor(counts * (int(round(target)) / (sizes * counts).sum())).astype(int), 2 * counts)
    spare = 2 * counts - base
    left = int(round(target)) - int((sizes * base).sum())
    best = min(abs(left - sum(k * s for k, s in zip(ks, sizes))) for ks in itertools.product(*[range(n + 1) for n in spare]))
    assert abs(int(round(target)) - int((sizes * take).sum())) == best


def test_fit_budget_with_long_documents_and_a_large_budget():
    rng = np.random.default_rng(2)
    sizes = np.arange(1, 5000)
    counts = rng.integers(1, 50, len(sizes))
    total = int((sizes * counts).sum())
    for part in (0.001, 0.37, 1.0, 1.6180339, 2.0):
        take = mixing.fit_budget(sizes, counts, part * total)
        assert abs(int((sizes * take).sum()) - part * total) <= 1
        share = take.sum() / counts.sum()
        assert abs(share - part) < 0.05  # the length distribution is kept
    assert mixing.fit_budget([20_000], [2], 35_000.0, dp_words=100).tolist() == [2]
    assert mixing.fit_budget([20_000], [2], 25_000.0, dp_words=100).tolist() == [1]


def test_mix_edges_and_hot_groups(spark):
    docs = with_clashes(edge_documents(spark), ["size", "src", "h", "bucket", "n", "taken", "copies", "target", "words"])
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count() and all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    assert all(r["size"] == 0 for r in got if r["doc_id"] in (3, 4, 6))
    assert mixing.mix(docs.limit(0)).collect() == []
    zero = mixing.mix(spark.createDataFrame([(1, "", "en", "a", 0), (2, None, "en", None, 0)], SCHEMA)).collect()
    assert [(r["target"], r["taken"]) for r in zero] == [(0.0, 0), (0.0, 0)]
    # a third of all rows are copies of one text, so of one size
    hot = spark.range(900).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same copy here")).otherwise(
        F.concat_ws(" ", F.lit("w"), F.expr("repeat('x ', cast(id % 40 as int))"))).alias("text"), F.lit("en").alias("lang"),
        F.when(F.col("id") % 2 == 0, F.lit("a")).otherwise(F.lit("b")).alias("source"), F.lit(0).cast("long").alias("n_chars"))
    first, second = (rows_of(mixing.mix(d), "doc_id", "taken") for d in (hot, hot.repartition(7)))
    assert first == second  # reruns agree however the rows lie
    sums = mixing.mix(hot).groupBy("source_size", "target").agg(F.sum("taken").alias("t")).collect()
    assert all(abs(r["t"] - r["target"]) <= 1 for r in sums)


def test_mixed_documents_repeats_rows(spark):
    docs = with_clashes(edge_documents(spark), ["_copies", "_h", "size"])
    plan = Counter()
    for r in mixing.mix(docs).collect():
        plan[r["doc_id"]] += r["copies"] if r["size"] else 1
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert Counter(r["doc_id"] for r in out.collect()) == Counter({k: v for k, v in plan.items() if v})


# --- n-gram Jaccard join

def shingles(text, n=4):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def plain_components(rows, n=4, percent=85):
    """rows: (id, text); all pairs are compared."""
    sets = [(i, shingles(t, n)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (i, a), (j, b) in itertools.combinations(sets, 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            x, y = sorted((find(i), find(j)))
            root[y] = x
    return sorted(((i, len(shingles(t, n)), None if i is None else find(i)) for i, t in rows), key=repr)


def test_join_query_equals_brute_force(spark):
    rows = [(d["doc_id"], d["text"]) for d in documents(SF_SMALL)]
    assert rows_of(QUERIES["op4_ngram_join"](spark, SF_SMALL), "doc_id", "n_shingles", "component_id") == plain_components(rows)


def near_copies(spark, n=150, words=60, edits=3):
    """One large group of near copies of a text that is not among them, some chains, and a passage that others share."""
    rng = random.Random(8)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(words)]
    rows = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.randrange(1, edits + 1)):
            own[rng.randrange(words)] = f"e{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(own)))
    rows += [(1000 + i, " ".join(base[:30] + [f"z{rng.randrange(10 ** 6)}" for _ in range(60)])) for i in range(60)]
    chain = [f"c{i}" for i in range(200)]
    rows += [(2000 + i, " ".join(chain[3 * i:3 * i + 120])) for i in range(12)]
    return rows


def test_join_on_near_copies_and_split_lists(spark, monkeypatch):
    rows = near_copies(spark)
    want = plain_components(rows)
    assert len({c for _, _, c in want}) < len(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    run = lambda: rows_of(ngram_join.ngram_jaccard_join(df), "doc_id", "n_shingles", "component_id")
    assert run() == want
    monkeypatch.setattr(ngram_join, "LIST_ROWS", 20)  # hot lists are cut in parts
    monkeypatch.setattr(ngram_join, "HEAVY", 0)  # the order is by hash alone: more candidates, the same links
    assert run() == want


def test_join_sends_no_square_of_candidates(spark, monkeypatch):
    """Copies changed in one of 24 places link with those of the same place only (Jaccard 0.849 with the others, whose bitmaps
    don't tell): what the second round makes grows with the group, not with its square."""
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(base[:6 * (i % 24) + 3] + [f"e{i}a", f"e{i}b", f"e{i}c"] + base[6 * (i % 24) + 6:])) for i in range(240)]
    made, real = [], (ngram_join.candidates, getattr(ngram_join, "joining_links", None))

    def counted(out):
        made.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "candidates", lambda lists, k, every, p: counted(real[0](lists, k, every, p)) if every else real[0](lists, k, every, p))
    monkeypatch.setattr(ngram_join, "joining_links", lambda *a: counted(real[1](*a)), raising=False)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_components(rows)
    assert len({c for _, _, c in want}) == 24
    run = lambda: rows_of(ngram_join.ngram_jaccard_join(df), "doc_id", "n_shingles", "component_id")
    assert run() == want and sum(made) <= 4 * len(rows)
    for part, members in ((5_000, 2_048), (1 << 19, 20)):  # the group is cut in parts, by shingles or by members
        monkeypatch.setattr(ngram_join, "PART_SHINGLES", part, raising=False)
        monkeypatch.setattr(ngram_join, "LIST_ROWS", members)
        assert run() == want


def random_part(rng, n, comps, sides):
    """Members of a part: sets that are one base with changes, lists of some of a few shingles."""
    base = rng.choice(1 << 40, 60, replace=False).astype(np.uint64)
    rows = []
    for i in range(n):
        own = base.copy()
        own[rng.choice(60, rng.integers(0, 8), replace=False)] = rng.integers(1 << 41, 1 << 42, 1, dtype=np.uint64)
        rows.append((i, int(rng.integers(comps)), int(rng.choice(sides)), np.unique(rng.integers(0, 4, 2)), np.unique(own).tobytes()))
    return pd.DataFrame(rows, columns=["id", "comp", "side", "lists", "shingles"])


@pytest.mark.parametrize("sides", [(0,), (1, 2), (1,), (2,)])
def test_links_of_a_part_join_what_all_its_links_join(sides):
    for seed in range(12):
        pdf = random_part(np.random.default_rng(seed), 40, (3, 1000)[seed % 2], sides)
        rows = pdf.to_dict("records")
        sets = [np.frombuffer(r["shingles"], np.uint64) for r in rows]
        pairs = [(i, j) for i, j in itertools.combinations(range(40), 2) if {rows[i]["side"], rows[j]["side"]} in ({0}, {1, 2})
                 and set(rows[i]["lists"]) & set(rows[j]["lists"]) and ngram_join.links(sets[i], sets[j])]
        found = ngram_join._part_links(pdf) if sides != (1,) else []

        def joined(edges):
            root = {i: r["comp"] for i, r in enumerate(rows)}
            for i, j in edges:
                root = {k: root[i] if c == root[j] else c for k, c in root.items()} if root[i] != root[j] else root
            return {frozenset(k for k in root if root[k] == c) for c in root.values()}

        assert set(found) <= set(pairs) and joined(found) == joined(pairs)
        assert len(found) == len(joined([])) - len(joined(pairs))


@pytest.mark.parametrize("words,small,large", [(60, 0, 4096), (60, 0, 0), (700, 256, 4096)])
def test_packed_sets_give_the_same_links(spark, monkeypatch, words, small, large):
    """Sets of all sizes travel packed (24 or 32 bits), and every pair near the threshold goes to its whole hashes."""
    rows = near_copies(spark, n=60, words=words, edits=max(3, words // 35))
    monkeypatch.setattr(ngram_join, "SMALL_SET", small)
    monkeypatch.setattr(ngram_join, "LARGE_SET", large)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(ngram_join.ngram_jaccard_join(df), "doc_id", "n_shingles", "component_id") == plain_components(rows)


def test_join_with_five_words_and_eighty_percent(spark):
    rows = near_copies(spark, n=60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = rows_of(ngram_join.ngram_jaccard_join(df, n=5, percent=80), "doc_id", "n_shingles", "component_id")
    assert got == plain_components(rows, 5, 80) != plain_components(rows)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 6000), st.integers(0, 900), st.integers(0, 900), st.integers(0, 99))
def test_packed_sets_never_judge_wrongly(both, only_a, only_b, seed):
    rng = np.random.default_rng(seed)
    every = np.unique(rng.integers(0, 1 << 64, both + only_a + only_b, dtype=np.uint64))
    rng.shuffle(every)
    a, b = np.sort(every[:both + only_a]), np.sort(np.concatenate((every[:both], every[both + only_a:])))
    verdict = ngram_join.judged(len(a), ngram_join.packed_set(a), len(b), ngram_join.packed_set(b))
    assert verdict in (int(ngram_join.links(a, b)), 2)
    if abs(100 * both / len(every) - 85) > 5:  # far from the threshold, the top bits tell
        assert verdict != 2 or len(every) < 400


def test_join_edges(spark):
    docs = with_clashes(edge_documents(spark), ["id", "n", "rep", "t", "component_id"])
    got = ngram_join.ngram_jaccard_join(docs).collect()
    assert len(got) == docs.count()
    by = {r["doc_id"]: r for r in got}
    assert by[1]["component_id"] == by[2]["component_id"] == by[10]["component_id"] == 1
    assert (by[3]["n_shingles"], by[3]["component_id"]) == (0, 3) and by[4]["n_shingles"] == 0 and by[6]["component_id"] == 6
    assert by[9]["n_shingles"] == 1 and by[None]["component_id"] is None
    assert by[8]["n_shingles"] == len(shingles(docs.where("doc_id = 8").first()["text"]))
    assert ngram_join.ngram_jaccard_join(docs.limit(0)).collect() == []


def test_join_of_one_id_with_two_texts(spark):
    rows = [(1, "a b c d e"), (5, "a b c d e"), (5, "v w x y z"), (7, "v w x y z"), (9, "other words stand here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = rows_of(ngram_join.ngram_jaccard_join(df), "doc_id", "component_id")
    assert got == [(1, 1), (5, 1), (5, 1), (7, 1), (9, 9)]


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 400), min_size=1), st.sets(st.integers(0, 400), min_size=1), st.sets(st.integers(0, 80), max_size=20))
def test_filters_never_drop_a_link(a, b, heavy):
    code = lambda s: np.sort(ngram_join.mix64(np.array(sorted(s), np.uint64), 42))
    x, y = code(a), code(b)
    orders = ngram_join.Orders(code(heavy) >> np.uint64(20) if heavy else np.zeros(0, np.uint64), np.arange(len(heavy)) + 3, 20)
    assert ngram_join.links(x, y) == (100 * len(a & b) >= 85 * len(a | b))
    bx, by = (ngram_join.bitmap(s) for s in (x, y))
    whole = lambda bits: (int.from_bytes(bits, "big"), len(bits))
    assert ngram_join.distance(*whole(bx), *whole(by)) == ngram_join.distance(*whole(by), *whole(bx)) <= len(a ^ b)
    assert ngram_join.distance(*whole(bx), *whole(bx)) == 0
    if ngram_join.links(x, y):
        for (p, _), (q, _) in zip(orders.prefixes(x, range(3)), orders.prefixes(y, range(3))):
            assert len(np.intersect1d(p, q))
        assert ngram_join.may_link(len(x), len(y), len(a ^ b))


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, (1 << 64) - 1)), st.dictionaries(st.integers(0, (1 << 30) - 1), st.integers(3, 1 << 40), max_size=50), st.integers(34, 60))
def test_weights_are_the_counts_of_heavy_shingles(plain, heavy, shift):
    heavy = {k % (1 << 64 - shift): c for k, c in heavy.items()}
    shingles = np.array(sorted(plain | {k << shift for k in heavy}), np.uint64)
    orders = ngram_join.Orders(np.array(list(heavy), np.uint64), np.array(list(heavy.values()), np.int64), shift)
    due = [min(heavy.get(int(x) >> shift, 0), (1 << 31) - 1) for x in shingles]
    assert orders.weights(shingles).tolist() == due


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, (1 << 24) - 1), min_size=1))
def test_packed_gaps_round_trip(numbers):
    low = np.sort(np.array(numbers, np.int64))
    assert ngram_join.unpack(ngram_join.pack(low)).tolist() == low.tolist()


def test_components_of_long_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200, 200 + i) for i in range(1, 80)] + [(500, 500), (300, 199)]
    got = dict(rows_of(ngram_join.components(spark.createDataFrame(edges, "a long, b long")), "id", "root"))
    assert all(got[i] == 0 for i in range(61)) and all(got[200 + i] == 200 for i in range(80))
    assert got[300] == got[199] == 199 and 500 not in got


# --- fingerprints

def test_fingerprint_query_texts_and_likeness(spark):
    docs = sorted(documents(SF_ORACLE), key=lambda d: -d["doc_id"])
    got = {r["doc_id"]: r for r in QUERIES["op8_fingerprints"](spark, SF_ORACLE).collect()}
    assert len(got) == len(docs)
    by_text = {}
    for i, d in enumerate(docs):
        text, after, r = d["text"], docs[(i + 1) % len(docs)], got[d["doc_id"]]
        m = len(text) // 3
        edited = text[:len(text) - m] + after["text"][:m]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
        by_text.setdefault(text, set()).add(r["fingerprint"])
        if after["text"] == text:
            assert r["near_next"] == 1
    assert all(len(x) == 1 for x in by_text.values())
    mean = lambda c: sum(r[c] for r in got.values()) / len(got)
    assert mean("near_edited") > 0.3 > 0.02 > mean("near_next")


def test_fingerprints_equal_brute_force(spark):
    """Subsets and their terms, from plain Python over the hashes that Spark gives the terms."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    words = {d["doc_id"]: {w for w in re.split(r"[^\w]|_", d["text"].lower()) if w} for d in documents(SF_SMALL)}
    n = len(words)
    df = Counter(w for s in words.values() for w in s)
    lex = {w for w, c in df.items() if max(2, 0.001 * n) <= c <= max(0.08 * n, 2)}
    every = spark.createDataFrame([(w,) for w in df], "w string")
    h = {r["w"]: r["h"] for r in every.select("w", fingerprints.term_hash(F.col("w")).alias("h")).collect()}
    groups, want = {}, {}
    for i, own in words.items():
        scale = max(0, int(np.floor(np.log2(max(len(own), 1) / (32 * 1.5)))))
        for cut in (0, 1, 2, 3):  # lexicon terms at two scales, then all terms
            mod = 32 << (scale + cut % 2)
            for k in range(32):
                terms = tuple(sorted(h[w] for w in (own & lex if cut < 2 else own) if h[w] % mod == k))
                if terms:
                    groups[terms] = None
                    want.setdefault(i, {}).setdefault(cut, {})[k] = terms
        want.setdefault(i, {})["scale"] = scale
    hashed = spark.createDataFrame([(list(t),) for t in groups], "t array<long>").select("t", fingerprints._hash_text(F.xxhash64("t")).alias("x"))
    groups = {tuple(r["t"]): r["x"] for r in hashed.collect()}
    got = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprints(docs).collect()}
    for i, w in want.items():
        if 0 in w:
            parts = [",".join(sorted(f"{k}.{groups[t]}" for k, t in w.get(c, {}).items())) for c in (0, 1, 2, 3)]
            assert got[i] == ":".join([str(w["scale"]), *parts])
        else:
            assert got[i].startswith("x:")


@pytest.mark.parametrize("folder", [SF_SMALL, SF_ORACLE])
def test_likeness_of_the_returned_fingerprints_is_the_reported_one(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    if folder == SF_SMALL:
        docs = docs.select("doc_id", "text").unionByName(edge_documents(spark).selectExpr("doc_id + 100000 AS doc_id", "text"))
    got = fingerprints.fingerprints(docs).where("doc_id is not null")
    order = got.select("doc_id", "fingerprint").collect()
    following = {}
    ids = sorted({r["doc_id"] for r in order}, reverse=True)
    by = {r["doc_id"]: r["fingerprint"] for r in order}
    for i, d in enumerate(ids):
        following[d] = by[ids[(i + 1) % len(ids)]]
    after = spark.createDataFrame(list(following.items()), "doc_id long, after string")
    near = fingerprints.likeness
    rows = got.join(after, "doc_id").select("doc_id", "near_edited", "near_next", near(F.col("fingerprint"), F.col("edited_fingerprint")).alias("a"),
                                            near(F.col("fingerprint"), F.col("after")).alias("b")).collect()
    assert len(rows) >= len(ids) and all(r["near_edited"] == r["a"] for r in rows)
    several = {100010, 100011, 100012, ids[-1]} if folder == SF_SMALL else set()  # ids of several rows, or followed by such or by a null id
    assert all(r["near_next"] == r["b"] for r in rows if r["doc_id"] not in several)


def test_fingerprint_edges(spark):
    docs = with_clashes(edge_documents(spark), ["id", "ik", "th", "term", "h", "of", "copies", "range", "next_ik"])
    got = fingerprints.fingerprints(docs).collect()
    assert len(got) == docs.count()
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    assert by[1][0]["fingerprint"] == by[2][0]["fingerprint"] == by[10][0]["fingerprint"]
    assert by[10][0] == by[10][1] and by[3][0]["n_chars"] == by[4][0]["n_chars"] == 0
    assert by[3][0]["edited_sha256"] == hashlib.sha256(b"").hexdigest() and by[3][0]["near_edited"] == 1
    text12, text11 = (docs.where(f"doc_id = {i}").collect()[0]["text"] for i in (12, 11))
    room = len(text12) // 3
    options = {hashlib.sha256((text12[:len(text12) - room] + t["text"][:room]).encode()).hexdigest() for t in docs.where("doc_id = 11").collect()}
    assert by[12][0]["edited_sha256"] in options and text11
    assert fingerprints.fingerprints(docs.limit(0)).collect() == []
    one = fingerprints.fingerprints(spark.createDataFrame([(1, "abcdef", "en", "a", 6)], SCHEMA)).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest() and one["near_next"] == 1


def test_fingerprints_of_a_large_group_of_near_copies(spark):
    """A third of the rows are near copies, and what they share is above the band; edits are new words or words of the band."""
    rng = random.Random(4)
    common = [f"common{i}" for i in range(2000)]
    base = [f"base{i}" for i in range(200)]
    group = [*range(50), *range(52, 252, 4)]
    rows = {i: rng.sample(common, 80) for i in range(300)}
    for i in group:
        rows[i] = list(base)
        rows[i][rng.randrange(200)] = f"new{i}"
        for at in rng.sample(range(200), 6 * (i % 2)):
            rows[i][at] = rng.choice(common)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in rows.items()], "doc_id long, text string")
    got = {r["doc_id"]: r for r in fingerprints.fingerprints(docs).collect()}
    assert min(got[i]["near_edited"] for i in group) > 0.1
    assert min(got[i]["near_next"] for i in range(1, 50)) > 0.4
    assert max(got[i]["near_next"] for i in range(51, 300)) < 0.2  # unrelated texts share a few words by chance
    pairs = spark.createDataFrame([(got[i]["fingerprint"], got[i - 1]["fingerprint"]) for i in range(1, 50)], "a string, b string")
    assert all(r["x"] > 0.4 for r in pairs.select(fingerprints.likeness(F.col("a"), F.col("b")).alias("x")).collect())


def test_fingerprints_run_no_python(spark):
    edited, _ = fingerprints.edit_with_next(edge_documents(spark).select(F.col("doc_id").alias("id"), "text"))
    lex = fingerprints.lexicon(edge_documents(spark), F.col("text"))
    for df in (lex, fingerprints.both_fingerprints(edited, lex)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


# --- pipeline

def stage_outputs(spark, docs, sf_dir):
    import corpus_pipeline

    from pairforge.session import shared_dir

    for name, stage in corpus_pipeline.STAGES:
        path = shared_dir(spark, "t_pipeline", unique=True)
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        yield name, docs, (docs := spark.read.parquet(path))


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, before, after in stage_outputs(spark, docs, SF_SMALL):
        seen[name] = (before.toPandas(), after.toPandas())
        if name != "bpe":
            assert after.columns == columns
    before, after = seen["language_id"]
    assert set(after["doc_id"]) <= set(before["doc_id"]) and len(after) >= 0.95 * len(before)
    before, after = seen["ngram_jaccard_join"]
    want = {i for i, _, c in plain_components(list(zip(before["doc_id"], before["text"])), 5, 80) if i == c}
    assert set(after["doc_id"]) == want and len(after) == len(want)
    before, after = seen["secret_scan"]
    assert sorted(before["doc_id"]) == sorted(after["doc_id"])
    from pairforge.llm.secrets import base_spans
    assert not any(base_spans(t) for t in after["text"]) and any(base_spans(t) for t in before["text"])
    assert all(len(t) == n for t, n in zip(after["text"], after["n_chars"]))
    before, after = seen["mix"]
    assert after["doc_id"].value_counts().max() <= 2 and set(after["doc_id"]) <= set(before["doc_id"])
    sizes = {}
    for s, t in zip(before["source"], before["text"]):
        sizes.setdefault(s, Counter())[plain_size(t)] += 1
    want = plain_targets({s: sum(n * c for n, c in own.items()) for s, own in sizes.items()})
    for s, own in sizes.items():
        take = mixing.fit_budget(np.array(sorted(own)), np.array([own[n] for n in sorted(own)]), want[s], zlib.crc32(f"={s}".encode()))
        assert sum(plain_size(t) for x, t in zip(after["source"], after["text"]) if x == s) == int((np.array(sorted(own)) * take).sum())
    assert len(seen["bpe"][1]) == len(after)
    got = corpus_pipeline.run(spark, SF_SMALL).toPandas()
    assert sorted(got["ids_sha256"]) == sorted(seen["bpe"][1]["ids_sha256"])


def test_pipeline_stages_on_edge_rows(spark):
    edge = with_clashes(edge_documents(spark), ["_judged", "_clean", "_copies", "id", "n", "_rank", "_k", "_o", "_rows", "_h"])
    for name, before, after in stage_outputs(spark, edge, SF_SMALL):
        assert name == "bpe" or after.columns == edge.columns
    for name, stage in __import__("corpus_pipeline").STAGES:
        out = stage(spark, edge, SF_SMALL).collect()
        assert out or name == "language_id"
        assert stage(spark, edge.limit(0), SF_SMALL).collect() == []
    kept = __import__("corpus_pipeline").near_duplicates(spark, edge, SF_SMALL).collect()
    assert Counter(r["doc_id"] for r in kept if r["doc_id"] in (10, 11)) == {11: 1}
