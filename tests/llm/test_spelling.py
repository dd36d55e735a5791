"""Spelling variants: hashes of edits, filters, and whole results against plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pairforge.llm import spelling as sp
from pairforge.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.edge import SCHEMA, edge_documents, rows_of, with_clashes

COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def lower(run):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)


def plain_words(rows, least_length=7):
    counts = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= least_length and n >= 2}


def is_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + 1:] == b[at + 1:] if len(a) == len(b) else a[at:] == b[at + 1:]


def plain(counts):
    near = defaultdict(set)
    by_length = defaultdict(list)
    for w in counts:
        by_length[len(w)].append(w)
    for length, own in by_length.items():
        for a in own:
            for b in own + by_length.get(length + 1, []):
                if is_near(a, b):
                    near[a].add(b)
                    near[b].add(a)
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * n else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def grouped(spark, counts):
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    return rows_of(sp.group_variants(df.repartition(3)), *COLUMNS)


@settings(max_examples=100, deadline=None)
@given(st.text("abéz", min_size=1, max_size=9))
def test_hashes_of_edits_are_those_of_the_words(word):
    codes, alphabet = sp.code_points([word], len(word)), np.array([ord(c) for c in "abéz"], np.uint32)
    spelled = lambda w: int(sp.word_hashes(sp.code_points([w], len(w)))[0])
    replaced = sp.replacement_hashes(codes, alphabet)[0]
    for i in range(len(word)):
        for j, c in enumerate("abéz"):
            assert int(replaced[i, j]) == spelled(word[:i] + c + word[i + 1:])
    if len(word) > 1:
        for i, h in enumerate(sp.deletion_hashes(codes)[0].tolist()):
            assert h == spelled(word[:i] + word[i + 1:])


def test_filters_lose_no_word_and_take_few_others():
    rng = np.random.default_rng(2)
    own, other = rng.integers(0, 1 << 64, 30_000, dtype=np.uint64), rng.integers(0, 1 << 64, 30_000, dtype=np.uint64)
    parts = sp.slice_of(own, 3)
    filters = sp.Filters({7: 3, 9: 1}, {(7, k): sp.build_filter(own[parts == k]).tobytes() for k in range(3)} | {(9, 0): sp.build_filter(other).tobytes()})
    assert len(filters.hits(7, own)) == len(own)
    assert len(filters.hits(7, other)) < 0.005 * len(other)
    assert len(filters.hits(8, own)) == 0 and len(filters.hits(9, other)) == len(other)


def test_query_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = rows_of(QUERIES["op11_spelling_variants"](spark, SF_SMALL), *COLUMNS)
    assert got == plain(plain_words(rows)) and any(r[1] for r in got) and any(r[4] for r in got)


@pytest.mark.parametrize("round_bytes,slice_words,edits", [(40 << 20, 1 << 17, 1 << 18), (300, 40, 500)])
def test_chains_ties_long_words_rounds_and_slices(spark, monkeypatch, round_bytes, slice_words, edits):
    for name, value in (("ROUND_BYTES", round_bytes), ("SLICE_WORDS", slice_words), ("EDITS", edits)):
        monkeypatch.setattr(sp, name, value)
    rng = random.Random(3)
    counts = {"spelling": 50_000, "speling": 5_000, "spelin": 500, "speliñ": 50, "spelinz": 4, "bbspelin": 2,
              "tieaaaa": 2, "tiebaaa": 20, "tiecaaa": 20, "aaaaaaa": 3, "aaaaaaaa": 30, "aaaaaaaaa": 299}
    for length in (300, 301, 70):
        counts["x" * length] = 5 * length
    counts["x" * 299 + "y"] = 7
    for _ in range(300):
        w = [rng.choice("abc") for _ in range(rng.randrange(7, 10))]
        counts["".join(w)] = rng.randrange(2, 2000)
    assert grouped(spark, counts) == plain(counts)
    assert grouped(spark, {"aaaaaaa": 2}) == plain({"aaaaaaa": 2})


def test_words_of_edge_rows(spark):
    docs = edge_documents(spark)
    more = [(30, "Straße ÄpfelÄpfel äpfelÄpfel ××÷÷××÷ äbcdefghij İstanbulu", "de", "a", 1)] * 2
    more += [(31, "x" * 40_000 + " " + "x" * 40_001, "en", "a", 1)] * 2 + [(None, "spelling Spelling SPELLING", "en", "a", 1)]
    more += [(i, "committee committees", "en", "a", 1) for i in range(100, 190)]
    df = with_clashes(docs.unionByName(spark.createDataFrame(more, SCHEMA)), ["id", "run", "word", "n", "near"])
    found = sp.runs(df, "doc_id", "text")
    vocabulary = sp.words(found, sp.with_slips(found))
    want = plain_words([(r["doc_id"], r["text"]) for r in df.collect()])
    assert {r["word"]: r["n"] for r in vocabulary.collect()} == want
    assert rows_of(sp.group_variants(vocabulary), *COLUMNS) == plain(want)


def test_empty_tables(spark):
    docs = edge_documents(spark).where("false")
    found = sp.runs(docs, "doc_id", "text")
    assert sp.group_variants(sp.words(found, F.col("run"))).collect() == []
