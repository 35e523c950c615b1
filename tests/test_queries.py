"""Each registered climate query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__
from gridloom.plans import catalogue

TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations embeddings".split()
NAMES = sorted(catalogue.queries())


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 5) + 0.0
    if isinstance(v, bool) or v is None:
        return v
    return v.isoformat()[:19] if hasattr(v, "isoformat") else float(v) if isinstance(v, int) else str(v)


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf, db, name):
    df = catalogue.queries()[name](spark, sf)
    names = sorted(df.columns)
    got = ordered(tuple(plain(r[c]) for c in names) for r in df.collect())
    if name not in catalogue.oracle_sql():
        assert got
        return
    rel = db.execute(catalogue.oracle_sql()[name])
    own = [d[0] for d in rel.description]
    assert sorted(own) == names
    at = [own.index(c) for c in names]
    want = ordered(tuple(plain(r[i]) for i in at) for r in rel.fetchall())
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert all(a == b or (isinstance(a, float) and isinstance(b, float) and abs(a - b) <= 2e-5 * max(1, abs(a))) for a, b in zip(g, w)), (g, w)


def test_entry(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and df.columns[:4] == ["model", "scenario", "cell_id", "year"]
