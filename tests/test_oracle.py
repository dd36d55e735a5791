"""Every registered contract query against its DuckDB twin (sf0.001, whole tables)."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from pairforge.plans.catalog import QUERIES

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
NAMES = sorted(QUERIES)  # the inventory's queries; optional subpackages test their own


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return repr(v.item() if hasattr(v, "item") else v)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["row_id", "prompt", "chosen", "rejected", "margin"]


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    scols = list(sdf.columns)
    srows = sdf.collect()
    cur = duck.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(scols) == sorted(dcols)
    cols = sorted(scols)
    s = Counter(tuple(_norm(r[scols.index(c)]) for c in cols) for r in srows)
    d = Counter(tuple(_norm(r[dcols.index(c)]) for c in cols) for r in drows)
    assert s == d
