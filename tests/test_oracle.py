"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from terrace.plans import queries as base
from terrace.sources.tables import STAR_TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ")
    return v


def _key(r):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in STAR_TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(base.QUERIES) <= set(E.queries()) and set(base.QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(base.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    rel = con.sql(E.oracle_sql()[name])
    ocols = rel.columns
    assert sorted(ocols) == cols
    order = sorted(range(len(ocols)), key=lambda i: ocols[i])
    orows = sorted((tuple(_norm(r[i]) for i in order) for r in rel.fetchall()), key=_key)
    assert rows == orows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "dynamic_rank" in df.columns
