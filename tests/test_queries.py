"""Every registered query with SQL gives DuckDB's rows on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from arborline.plans.queries import QUERIES, SQL

FOLDER = os.environ.get("ARBORLINE_TEST_TABLES", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return round(float(v), 6) + 0.0 if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_duckdb(spark, duck, name):
    ours = QUERIES[name](spark, FOLDER)
    names = sorted(ours.columns)
    theirs = duck.execute(SQL[name])
    assert sorted(c[0] for c in theirs.description) == names
    order = [[c[0] for c in theirs.description].index(n) for n in names]
    want = sorted([tuple(_plain(r[i]) for i in order) for r in theirs.fetchall()], key=str)
    got = sorted([tuple(_plain(r[n]) for n in names) for r in ours.collect()], key=str)
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0
