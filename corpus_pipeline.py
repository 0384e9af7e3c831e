"""From documents to packed training sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and gives the documents it keeps, with the columns of
``documents``; the last gives the pieces of packed sequences. ``run`` writes each stage's rows
to the shared folder and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm.common import load, remainder, stored
from rowtide.llm.langid import fit_languages
from rowtide.llm.mixing import mix
from rowtide.llm.packing import pack
from rowtide.llm.quality import fit_quality
from rowtide.llm.queries import tokenizer_file
from rowtide.llm.simhash import keep_one_of_each

QUALITY_THRESHOLD = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose neighbours among the labelled ones vote for quality.

    Rows without text or terms are like no labelled text and stay, their score being even.
    """
    labels = load(spark, sf_dir, "labels").filter(remainder(F.col("doc_id"), 5) != 0)
    model = fit_quality(docs, labels)
    return docs.filter(model.column(F.col("text")) >= QUALITY_THRESHOLD)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that one dictionary fits clearly better than the others.

    Null texts and texts without a letter go, as do those with a narrow margin.
    """
    model = fit_languages(docs.filter(remainder(F.col("doc_id"), 5) != 0))
    return docs.filter(model.column(F.col("text"))["accepted"])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest id."""
    return keep_one_of_each(docs, shingle=3, max_distance=2)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them: repeated, once or not at all."""
    return mix(docs, max_epochs=3.0, seed=0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens, next to their lexical neighbours."""
    return pack(docs, tokenizer_file(), end=2, window=4096)


STAGES = [
    ("quality", quality),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("packing", packing),
]

# The stages hold a trained classifier, compression, 64-bit hashes and a tokenizer, which SQL
# cannot express; tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that all stages together make of ``documents``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
