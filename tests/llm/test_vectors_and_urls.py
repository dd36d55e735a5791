"""Exact top-k and the URL filter."""

import math
import re

import numpy as np
import pyarrow.parquet as pq
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairforge.llm import topk, urls
from pairforge.llm.queries import QUERIES, URL_RULES
from tests.conftest import SF_ORACLE
from tests.llm.edge import rows_of, with_clashes


def brute_top(rows, is_query, k=5, scale=256):
    ok = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if is_query(q):
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q and len(a) == len(b))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out, key=repr)


def test_top_k_query_equals_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in pq.read_table(f"{SF_ORACLE}/embeddings.parquet").to_pylist()]
    got = rows_of(QUERIES["op5_top_k"](spark, SF_ORACLE), "query_id", "rank", "vec_id", "score")
    assert got == brute_top(rows, lambda q: q % 50 == 0)


def test_top_k_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25]), (50, [0.5, -0.25]), (1, [0.5, -0.25]), (2, [nan, 1.0]), (3, [inf, 1.0]), (4, None), (5, [None, 1.0]),
            (6, [1.0, 2.0, 3.0]), (100, [1.0, 0.0, 0.001]), (7, []), (150, []), (8, [0.0, 0.0]), (9, [-0.001, 0.001]), (None, [1.0, 1.0]),
            (200, [3e6, -3e6]), (10, [4e6, 5e6]), (11, [0.5, -0.25])]
    df = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), ["score", "rank", "dim", "block", "qb", "salt"])
    got = rows_of(topk.top_k(df, F.pmod("vec_id", F.lit(50)) == 0), "query_id", "rank", "vec_id", "score")
    assert got == brute_top(rows, lambda q: q % 50 == 0)
    assert topk.top_k(df.limit(0), F.pmod("vec_id", F.lit(50)) == 0).collect() == []


def test_top_k_repeated_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    got = rows_of(topk.top_k(df, F.col("vec_id") == 0, k=2), "query_id", "vec_id", "score")
    assert set(got) == {(0, 1, 131072)}


def test_index_stops_early_and_stays_exact():
    rng = np.random.default_rng(1)
    x = np.floor(256 * rng.normal(0, 0.12, (3000, 64)))
    x[:40] = np.floor(x[0] * 0.98)  # near the first query
    x[2000:2300] = x[1]  # ties
    ids = rng.permutation(3000)
    found, passes = topk.ImpactIndex(ids, x).top(ids[:60], x[:60], 5)
    got = {}
    for q, i, s in found:
        got.setdefault(q, []).append((-s, i))
    full = 60 * len(topk.ImpactIndex(ids, x).segments)
    assert passes < full
    for at in range(60):
        want = sorted((-int(s), int(i)) for s, i in zip(x @ x[at], ids) if i != ids[at])[:5]
        assert sorted(got[ids[at]])[:5] == want


# --- urls

def plain_url(url):
    m = re.search(r"://", url or "")
    if not m:
        return "", ""
    rest = url[m.end():]
    host = re.match(r"[^/?#]*", rest).group()
    tail = rest[len(host):]
    path = re.match(r"[^?#]*", tail).group() if tail.startswith("/") else ""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path, rules):
    fits = [(len(h) + len(p), len(h), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, None)


HOSTS = st.lists(st.sampled_from(["www", "example", "com", "net", "", "COM", "x"]), max_size=4).map(".".join)
PATHS = st.lists(st.sampled_from(["en", "es", "fr", "", "english", "a"]), max_size=4).map("/".join)
MORE = (("block", "net", ""), ("allow", "example.com", "/e"), ("block", "com", "/en"), ("allow", "x.net", "/a/e"))


@settings(max_examples=400, deadline=None)
@given(HOSTS, PATHS, st.sampled_from(["", "/"]), st.sampled_from(["", "?a=/en/", "#://x"]))
def test_trie_equals_the_plain_rules(host, path, slash, tail):
    h, p = urls.split_url(f"https://{host}{slash}{path if slash else ''}{tail}")
    assert (h, p) == plain_url(f"https://{host}{slash}{path if slash else ''}{tail}")
    for rules in (URL_RULES, MORE):
        assert urls.UrlTrie(rules).longest(h, p) == plain_rule(h, p, rules)


def test_url_filter_edges(spark):
    rows = [(1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "HTTP://WWW.EXAMPLE.COM/en/a?x#y"), (6, "http://example.com"),
            (7, "x://a.net/es/"), (7, "x://a.net/es/"), (None, "x://b.com/"), (8, "://\u0130.com/" + "a/" * 50_000)]
    df = with_clashes(spark.createDataFrame(rows, "page_id long, url string"), ["host", "path", "_key", "_url", "rule"])
    got = rows_of(urls.url_filter(df, URL_RULES), "page_id", "host", "path", "rule", "verdict")
    want = []
    for i, u in rows:
        h, p = plain_url(u)
        rule, verdict = plain_rule(h, p, URL_RULES)
        want.append((i, h, p, rule, verdict or "allow"))
    assert got == sorted(want, key=repr)
    assert urls.url_filter(df.limit(0), URL_RULES).collect() == []


def test_url_rules_are_checked():
    import pytest

    for bad in ([("maybe", "com", "/")], [("allow", "com", "x")], [("allow", "com", "/"), ("block", "COM", "/")]):
        with pytest.raises(ValueError):
            urls.UrlTrie(bad)
