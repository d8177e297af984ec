"""Every registered query against its SQL twin, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from check import rows_of
from wayfare.plans.catalog import registered

TINY = "/root/testdata/sf0.001"
ORACLE = contract.oracle_sql()
# The queries of this library's own tables; the others have tests of their own.
QUERIES = {name: contract.queries()[name] for name in registered()}


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for path in glob.glob(f"{TINY}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_every_query_has_a_twin():
    assert QUERIES.keys() <= ORACLE.keys()


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "revenue_linear" in df.columns


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sql, name):
    df = QUERIES[name](spark, TINY)
    cur = sql.execute(ORACLE[name])
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cur.fetchall())
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    for word in ("Join Cross", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert word not in plan
