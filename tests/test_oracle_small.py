"""Every registered query with an oracle: Spark result == DuckDB SQL result at sf0.001."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from meterline.sources.tables import TABLES

from conftest import SF_SMALL

ORACLE = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v)[:19]
    return v


def _digest(rows):
    return sorted(repr(tuple(_norm(x) for x in r)) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    s = _digest(tuple(r[c] for c in cols) for r in df.collect())
    cur = con.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    idx = sorted(range(len(ocols)), key=lambda i: ocols[i])
    o = _digest(tuple(r[i] for i in idx) for r in cur.fetchall())
    assert cols == sorted(ocols)
    assert s == o


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) >= {"cost_date", "controller", "tier", "total_cost"}
    assert df.count() >= 0
