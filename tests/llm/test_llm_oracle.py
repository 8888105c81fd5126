"""The queries that SQL can express against DuckDB, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from ledgerflow.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the given tables")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(llm_spark, name):
    with duckdb.connect() as con:
        for t in ("documents", "benchmark", "labels", "embeddings"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        result = con.execute(ORACLE_SQL[name])
        columns = [c[0] for c in result.description]
        want = sorted(result.fetchall())
    df = QUERIES[name](llm_spark, SF)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(tuple(r) for r in df.select(*columns).collect()) == want
