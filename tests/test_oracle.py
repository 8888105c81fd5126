"""Every catalogue query against its DuckDB oracle on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from ledgerflow.plans.catalog import QUERIES
from ledgerflow.plans.oracle import ORACLE_SQL
from tools.check_oracle import TABLES, kind_duck, kind_spark, rows_of

SF = os.environ.get("LEDGERFLOW_TEST_SF", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.exists(f"{SF}/orders.parquet"), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(ORACLE_SQL[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert {c: kind_spark(t) for c, t in sdf.dtypes} == {d[0]: kind_duck(d[1]) for d in res.description}
    assert len(srows) == len(orows)
    assert rows_of(sdf.columns, srows) == rows_of(ocols, orows)
    plan = sdf._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan and "PythonUDF" not in plan  # JVM-side only


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["o_orderkey", "due_date", "installment_no", "amount", "status"]
    assert df.count() > 0
