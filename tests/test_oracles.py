"""Every registered query against its DuckDB oracle on the smallest scale (rows, columns, values)."""

import decimal

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from candlelake.queries import QUERIES
from helpers import SF_SMALL

TABLES = ("orders", "customer", "lineitem", "events")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    if isinstance(v, float):
        return round(v, 6)
    return v


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(oracle_sql()) <= set(queries())


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns[:2] == ["symbol", "bar_date"] and df.count() > 0


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "date": "DATE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = queries()[name](spark, SF_SMALL)
    rows = [tuple(_norm(v) for v in r) for r in df.collect()]
    res = duck.execute(oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    otypes = {d[0]: str(d[1]) for d in res.description}
    assert {c: SPARK_TO_DUCK.get(t, t.upper()) for c, t in df.dtypes} == {c: otypes[c] for c in df.columns}
    idx = [ocols.index(c) for c in df.columns]
    orows = [tuple(_norm(r[i]) for i in idx) for r in res.fetchall()]
    assert len(rows) == len(orows)
    assert _sorted(rows) == _sorted(orows)
