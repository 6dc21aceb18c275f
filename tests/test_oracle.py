"""Every registered query against its DuckDB statement (section 5.1), on the
smallest scale factor: row count, column names and exact values."""

import duckdb
import pytest

import __spark_entry__ as E
from sensorstream import queries as _q

from .conftest import SF_SMALL

TABLES = ["events"]
# The corpus operators have their own tests.
QUERIES = {n: q for n, q in E.queries().items() if n in _q.QUERIES}
ORACLE = {n: s for n, s in E.oracle_sql().items() if n in _q.ORACLE}


def _norm(v):
    return repr(v) if isinstance(v, float) else (v.isoformat() if hasattr(v, "isoformat") else repr(v))


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(ORACLE[name])
    ocols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(got) == len(want)
    assert _rows(df.columns, got) == _rows(ocols, want)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["device_id", "window_start", "window_end", "avg_temp"]
    assert df.count() > 0
