"""Every registered query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as ent
from basketry.plans.registry import load_all

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
QUERIES = {n: e.fn for n, e in load_all().items()}
SQL = {n: e.sql for n, e in load_all().items() if e.sql}


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_every_query_has_oracle_sql():
    assert set(SQL) == set(QUERIES) <= set(ent.queries()) and set(SQL) <= set(ent.oracle_sql())


def test_entry_smoke(spark):
    df = ent.entry(spark)
    assert df.columns == ["window_start", "window_end", "currency", "total_revenue",
                          "order_count", "avg_order_value"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, sf_small, duck, name):
    df = QUERIES[name](spark, sf_small)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.sql(SQL[name])
    want = _rows(rel.columns, rel.fetchall())
    assert sorted(df.columns) == sorted(rel.columns)
    assert got == want
