"""Registered queries of this package against their DuckDB statements."""

import duckdb
import pytest

import __spark_entry__ as entry
from stockroute.llm import queries

TABLES = ("documents", "embeddings", "pages", "labels", "conversations")


def test_every_operator_is_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_statement(spark, sf_small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    got = entry.queries()[name](spark, sf_small)
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLES[name]})").fetchall()
    show = lambda rows: sorted(tuple(str(v) for v in r) for r in rows)
    assert show(got.select(*cols).collect()) == show(want)
