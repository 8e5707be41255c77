"""Driver contract: entry smoke run, and every registered query against its
DuckDB oracle on the smallest scale factor (rows, columns, values)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from strata.plans.oracles import ORACLES
from strata.plans.registry import QUERIES
from strata.plans.standins import TABLES
from tests.conftest import SF_SMALL


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "weighted_rating" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


def _norm(v):
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9) + 0.0)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return "NULL" if v is None else str(v)


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in data)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert _canon(df.columns, got) == _canon(cols, want)


def test_every_query_is_documented():
    from strata.plans.registry import QUERIES

    missing = [name for name, fn in QUERIES.items() if not (fn.__doc__ or "").strip()]
    assert not missing, missing
