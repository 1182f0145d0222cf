"""The entry points, and every query's SQL against its result at the smallest scale."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from indexloom import queries

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def same(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    return repr(round(float(v), 6)) if isinstance(v, (int, float)) and not isinstance(v, bool) or hasattr(v, "as_tuple") else str(v)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "final_score" in df.columns
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, oracle, name):
    df = queries.QUERIES[name](spark, DATA)
    got = df.select(sorted(df.columns)).collect()
    if name in queries.SQL:
        rel = oracle.sql(queries.SQL[name])
        order = sorted(rel.columns)
        want = rel.select(*[f'"{c}"' for c in order]).fetchall()
        assert order == sorted(df.columns)
        assert sorted(tuple(map(same, r)) for r in got) == sorted(tuple(map(same, r)) for r in want)


@pytest.mark.parametrize("name", ["country_index", "retrieval_limited", "enforcement_top", "cosine_topk", "upsert_latest", "sensitivity_long"])
def test_plans_stay_in_the_jvm(spark, name):
    plan = queries.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInArrow" not in plan and "CartesianProduct" not in plan
