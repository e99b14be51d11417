"""The registered queries against DuckDB, against brute force, and for the columns their contracts name."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from terrace.llm import jaccard_join, oracle, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

COLUMNS = {
    "op2": ["doc_id", "held_out", "score", "predicted"], "op3": ["doc_id", "held_out", "lang_pred", "score"],
    "op4": ["doc_id", "size", "source_size", "target", "taken"], "op5": ["query_id", "rank", "vec_id", "score"],
    "op6": ["doc_id", "n_shingles", "component_id"],
    "op7": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op8": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op9": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op10": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "labels"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries()) and len(queries.QUERIES) == 13
    assert set(oracle.SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(r[c] for c in cols) for r in df.collect())
    rel = con.sql(oracle.SQL[name])
    want = sorted(tuple(r[rel.columns.index(c)] for c in cols) for r in rel.fetchall())
    assert sorted(rel.columns) == cols and len(got) == len(want)
    for a, b in zip(got, want):
        assert all(x == y or (isinstance(x, float) and math.isclose(x, y, rel_tol=1e-12)) for x, y in zip(a, b))


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(oracle.SQL)))
def test_columns_and_rows(spark, con, name):
    df = E.queries()[name](spark, SF)
    want = COLUMNS.get(name.split("_")[0], ["doc_id"])
    assert df.columns[:len(want)] == want
    n = con.execute("SELECT count(*) FROM documents").fetchone()[0]
    m = con.execute("SELECT 20 * count(*) FROM embeddings WHERE vec_id % 20 = 0").fetchone()[0]
    assert df.count() == (m if name.startswith("op5") else n)


def test_components_of_the_table(spark, con):
    from tests.llm.test_jaccard import brute, components
    rows = con.execute("SELECT doc_id, text FROM documents").fetchall()
    assert components(queries.QUERIES["op6_jaccard_regions"](spark, SF)) == brute(rows)
    assert jaccard_join.WORDS == 4
