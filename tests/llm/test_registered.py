"""The registered queries against their SQL."""

import duckdb
import pandas as pd
import pytest

from rowtide.llm import queries

TABLES = "documents embeddings pages labels conversations".split()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    expected = duck.execute(queries.ORACLES[name]).df()
    got = queries.QUERIES[name](spark, sf_dir).toPandas()
    columns = sorted(expected.columns)
    assert sorted(got.columns) == columns and len(got)
    in_order = [df[columns].sort_values(columns).reset_index(drop=True) for df in (got, expected)]
    pd.testing.assert_frame_equal(*in_order, check_dtype=False)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].partition("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
