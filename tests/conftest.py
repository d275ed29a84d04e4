import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF = "/root/testdata/sf0.01"
SF_SMALL = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="session")
def spark():
    from meterline.session import get_spark
    s = get_spark("tests", "*", 8)
    yield s


def _norm(v):
    if v is None:
        return "NULL"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def rows_digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="session")
def duck():
    def make(sf=SF):
        con = duckdb.connect()
        for t in TABLES:
            p = f"{sf}/{t}.parquet"
            if os.path.exists(p):
                con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
        return con
    cache = {}

    def get(sf=SF):
        if sf not in cache:
            cache[sf] = make(sf)
        return cache[sf]
    return get


def assert_same(df, con, sql):
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    srows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(ocols)
    a, b = rows_digest(df.columns, srows), rows_digest(ocols, orows)
    assert len(a) == len(b)
    assert a == b
