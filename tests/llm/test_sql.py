"""Queries against their SQL."""

import duckdb
import pytest

from revlens.llm import queries, sql


@pytest.mark.parametrize("name", list(sql.SQL))
def test_query_equals_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    df = queries.QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    want = connection.execute(f"SELECT {', '.join(columns)} FROM ({sql.SQL[name]})").fetchall()
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(want)
