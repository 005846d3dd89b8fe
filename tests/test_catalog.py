"""Every registered query runs at sf0.001; those with an oracle match DuckDB."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from stockroute.plans import catalog, catalog_more  # noqa: F401

QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
SLOW = {"M9_planning_run"}


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10]
    if isinstance(v, bool):
        return str(int(v))
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_small}/{t}.parquet'")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["Store", "n", "mae", "rmse", "r2"]
    assert df.count() > 0


def test_every_query_has_a_known_id():
    qs, sqls = QUERIES, ORACLES
    assert set(sqls) <= set(qs) <= set(E.queries())
    assert len(sqls) >= 20
    for name in qs:
        assert name.split("_")[0][0] in "ABCDEFGHIJKLM", name


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES) - SLOW))
def test_rows_only_queries_run(spark, sf_small, name):
    df = QUERIES[name](spark, sf_small)
    assert df.count() >= 0
    assert len(df.columns) > 0
