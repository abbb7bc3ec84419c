"""Every registered query against its DuckDB oracle SQL on the smallest driver tables.

This is the same comparison the driver makes at sf0.01 (row count, column names,
order-insensitive values); queries without SQL are checked to run and return rows.
"""

import math

import duckdb
import pytest

import __spark_entry__ as E
from threadmill.sources.tables import TABLES

from conftest import SF_SMALL

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "__float__") and not isinstance(v, (int, bool)):
        return round(float(v), 6)
    return v


def _key(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and set(df.columns) == {"domain", "split", "n", "share"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert df.columns and srows
        return
    cur = duck.execute(ORACLE[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _key(srows, df.columns) == _key(cur.fetchall(), dcols)
