"""Every registered query against its DuckDB oracle on sf0.001, and the
entry smoke check."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from indicata.plans.driver_queries import QUERIES
from tests.conftest import DUCK_TYPES, norm

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["Periodo", "avg_ipc_mensual", "variacion_mensual", "avg_ipc_interanual"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    oracle_types = {r[0]: r[1] for r in duck.execute("DESCRIBE " + entry.oracle_sql()[name]).fetchall()}
    assert {c: DUCK_TYPES.get(t, t) for c, t in df.dtypes} == oracle_types
    cols = df.columns
    got = Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in cols]
    want = Counter(tuple(norm(r[i]) for i in idx) for r in res.fetchall())
    assert got == want
