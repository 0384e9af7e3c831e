import pytest
from pyspark.sql import functions as F

# Columns that operators might mistake for their own.
CLASHING = (
    "id row text2 score predicted fingerprint component_id size target whole cutoff copies key block place "
    "word n start length sequence_id shard lang_pred licenses first page payload digest v h1 h2 cell slot rank"
).split()


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Rows with nulls in every column, empty and very long texts, repeats, and extra columns."""
    long = "The house stands on a hill and the river runs below it. " * 20_000
    plain = "the quick brown fox jumps over the lazy dog near the river bank"
    rows = [
        (1, plain, "en", "a"),
        (1, plain, "en", "a"),
        (2, plain, "en", "b"),
        (3, "", "en", "a"),
        (4, None, None, None),
        (None, "a row without an id, but with words and a source", "en", "b"),
        (None, None, None, None),
        (5, " \t\n ", "fr", "c"),
        (6, long, "en", "a"),
        (7, "12 34 -- !!", None, "b"),
        (8, "one", "en", None),
        (9, "le renard brun saute par dessus le chien paresseux", "fr", "c"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    return docs.withColumns({name: F.lit(f"own {name}") for name in CLASHING})


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
