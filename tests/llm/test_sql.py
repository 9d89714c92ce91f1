"""The queries that SQL can express, against it."""

from pathlib import Path

import duckdb
import pytest

from feederlens.llm import oracle, queries

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test data")


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        duck.sql(f"CREATE VIEW {file.stem} AS FROM '{file}'")
    result = duck.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    df = queries.queries()[name](spark, SF)
    types = {"BIGINT": "bigint", "VARCHAR": "string", "DOUBLE": "double"}
    assert {d[0]: types[str(d[1])] for d in result.description} == dict(df.dtypes)
    assert sorted(map(repr, map(tuple, df.select(columns).collect()))) == sorted(map(repr, result.fetchall()))
