"""Driver contract: entry() runs; every query matches its DuckDB oracle on the
smallest testdata folder (the driver repeats this at sf0.01)."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from martlet.plans.catalog import CATALOG
from tests.conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "customer_id"


def test_every_query_has_an_oracle():
    assert set(CATALOG) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        path = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan" if math.isnan(v) else repr(v))
    if isinstance(v, decimal.Decimal):
        return (1, repr(float(v)))
    if isinstance(v, (dt.date, dt.datetime)):
        return (2, v.isoformat())
    return (3, str(v))


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, srows) == _rows(ocols, orows)
