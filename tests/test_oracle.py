"""Every batch catalogue query against its DuckDB oracle on sf0.001."""

import collections
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from strata.plans.catalog import catalog
from strata.sources.testdata import TABLES

from conftest import SF_SMALL

BATCH = list(catalog())


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 4) + 0.0
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", BATCH)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _bag(df.columns, rows) == _bag(ocols, res.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["dt", "hr", "amount"]
    assert df.count() > 0
