"""Every inventory query against its DuckDB oracle at sf0.001 (multiset equality)."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from huddle import inventory, oracle
from tests.conftest import SF001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(inventory.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", sorted(inventory.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    sc, sr = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(E.oracle_sql()[name])
    dc, dr = _rows([d[0] for d in cur.description], cur.fetchall())
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 544  # the figure of FIXTURES.md for sf0.001 over all dated rows
    assert "event_attendance_rate" in df.columns


def test_dim_projection_returns_every_projected_value(spark):
    from huddle.plans import dims
    df = E.queries()["prj_dim_rows"](spark, SF001)
    assert set(df.columns) == {"dim"}.union(*(cols for _, _, cols in dims.DIMS.values()))
    assert {r.dim for r in df.select("dim").distinct().collect()} == set(dims.DIMS)
