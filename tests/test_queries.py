"""Every registered query against its SQL, on the smallest tables."""

import datetime
import decimal
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as driver  # noqa: E402
from rowtide.plans import ORACLES, QUERIES  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, (decimal.Decimal, datetime.date)):
        return str(value)
    return value


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(plain(r[i]) for i in order) for r in rows), key=repr
    )


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    result = duck.execute(ORACLES[name])
    expected = table([c[0] for c in result.description], result.fetchall())
    got = table(df.columns, df.collect())
    assert got[0] == expected[0]
    assert got[1] == expected[1]
    assert got[1] or name.endswith("change_alerts")  # few changes an hour in the smallest tables


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns[:2] == ["pk_id", "op"] and df.count() > 0


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("missing", ["rowtide.llm", "rowtide.llm.queries", "tiktoken", "tokenizers", "corpus_pipeline"])
def test_the_core_does_without_the_text_operators(missing):
    """What they need, or they themselves, may be missing."""
    import subprocess
    code = (
        f"import sys; sys.modules[{missing!r}] = None\n"
        "import __spark_entry__ as e; from rowtide.plans import QUERIES\n"
        "assert set(QUERIES) <= set(e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
