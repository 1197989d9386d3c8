"""Every registered query against its DuckDB oracle on the smallest test data."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from mercato.plans.oracle import ORACLES
from mercato.plans.registry import QUERIES

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, t)}.parquet')")
    return c


def _key(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan" if math.isnan(v) else repr(v))
    return (1, str(v))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    cur = con.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(sdf.columns) == sorted(ocols)
    cols = sorted(ocols)
    got = sorted(tuple(_key(r[c]) for c in cols) for r in sdf.collect())
    want = sorted(tuple(_key(dict(zip(ocols, r))[c]) for c in cols) for r in cur.fetchall())
    assert got == want


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "seller_id" and df.count() > 0
