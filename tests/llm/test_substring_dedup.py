"""Substring dedup: the sketch loses nothing, and results equal plain Python."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pairforge.llm import substring_dedup as sd
from pairforge.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.edge import SCHEMA, edge_documents, rows_of, with_clashes


def plain(rows, width=13):
    """rows: (id, text) -> sorted (id, n_words, n_removed, kept)."""
    cut = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in cut:
        for s in range(len(w) - width + 1):
            if i is not None:
                k = tuple(w[s:s + width])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, w in cut:
        gone = set()
        for s in range(len(w) - width + 1):
            if i is not None and first[tuple(w[s:s + width])] < i:
                gone |= set(range(s, s + width))
        out.append((i, len(w), len(gone), " ".join(x for at, x in enumerate(w) if at not in gone)))
    return sorted(out, key=repr)


def found(df, **more):
    return rows_of(sd.dedup_substrings(df, **more), "doc_id", "n_words", "n_removed", "kept")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60), max_size=40), min_size=1, max_size=6))
def test_merged_sketch_never_falls_below_the_count(parts):
    """Whatever the collisions, a cell that two windows meet, in one chunk or in two, is reported to all of them."""
    blocks = sd.Blocks(0, cell_bits=3)
    hashes = [sd.mix64(np.array(p, np.uint64), 9) for p in parts]
    counts = Counter(h for part in hashes for h in part.tolist())
    for row in range(sd.DEPTH):
        cells = [sd.sketch(blocks.cells(h, row)) for h in hashes]
        for part, sent, often in zip(hashes, cells, sd.merged(cells)):
            reported = set(sent[often].tolist())
            for h, cell in zip(part.tolist(), blocks.cells(part, row).tolist()):
                assert counts[h] < 2 or cell in reported


def test_most_single_windows_stay_out_of_the_second_pass():
    rng = np.random.default_rng(4)
    blocks = sd.Blocks(1 << 18, block_windows=1 << 16, cell_bits=19)
    hashes = [rng.integers(0, 1 << 63, 1 << 15).astype(np.uint64) for _ in range(8)]
    estimate = [np.ones(len(h), bool) for h in hashes]
    for row in range(sd.DEPTH):
        cells = [blocks.cells(h, row) for h in hashes]
        all_cells, n = np.unique(np.concatenate(cells), return_counts=True)
        often = all_cells[n > 1]
        estimate = [e & sd._among(c, often) for e, c in zip(estimate, cells)]
    assert sum(e.sum() for e in estimate) < 0.05 * sum(map(len, hashes))


def test_query_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = [(i, n, gone, hashlib.sha256(kept.encode()).hexdigest()) for i, n, gone, kept in plain(rows)]
    got = rows_of(QUERIES["op13_substring_dedup"](spark, SF_SMALL), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert got == sorted(want, key=repr) and any(g[2] for g in got)


def test_edge_rows(spark):
    docs = edge_documents(spark)
    long = docs.where("doc_id = 8").first()["text"]
    more = spark.createDataFrame([(20, long, "en", "a", 1), (21, "x " * 5_000, "en", "a", 1), (22, "x " * 13, "en", "a", 1),
                                  (23, "pre " + "x " * 14 + "post", "en", "a", 1), (None, long, "en", "a", 1), (-3, long[:900], "en", "a", 1),
                                  (1 << 40, long[400:1400], "en", "a", 1)], SCHEMA)
    df = with_clashes(docs.unionByName(more), ["chunk", "data", "kind", "kept", "block"])
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert found(df) == plain(rows)
    assert found(df, width=3) == plain(rows, 3)
    assert found(df.where("false")) == []


@pytest.mark.parametrize("partitions", [1, 7])
def test_many_chunks_blocks_and_collisions(spark, monkeypatch, partitions):
    """Small chunks and a sketch so narrow that most windows are estimated repeated: results stay the same."""
    rng = random.Random(6)
    passages = [[rng.choice("abcdefgh") + str(rng.randrange(30)) for _ in range(20)] for _ in range(6)]
    rows = []
    for i in range(150):
        words = [rng.choice("abcdefgh") + str(rng.randrange(400)) for _ in range(rng.randrange(60))]
        for _ in range(rng.randrange(3)):
            p, at = rng.choice(passages), rng.randrange(len(words) + 1)
            words[at:at] = p[:rng.randrange(21)]
        if i % 3 == 0:  # a hot passage: in a third of all documents
            words += passages[0]
        rows.append((rng.randrange(1000), " ".join(words), "en", "a", 0))
    whole, narrow = sd.chunks, sd.Blocks
    monkeypatch.setattr(sd, "chunks", lambda *a: whole(*a, chunk_bytes=900))
    monkeypatch.setattr(sd, "Blocks", lambda n: narrow(n, cell_bits=9, block_windows=500))
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    assert found(df) == plain([r[:2] for r in rows])
