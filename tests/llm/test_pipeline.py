"""The pipeline's stages against plain decisions, each on the rows that the stage before kept."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rowtide.llm.common import remainder, stored
from rowtide.llm.langid import fit_languages
from rowtide.llm.mixing import mixing_plan, with_copies
from rowtide.llm.quality import fit_quality, term_counts
from rowtide.llm.simhash import simhash_duplicates

from .test_packing import check


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(stored(stage(spark, kept[-1], sf_dir), name))
    return kept


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "mixing", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_quality(spark, sf_dir, stages):
    import numpy as np

    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(remainder(F.col("doc_id"), 5) != 0)
    model = fit_quality(stages[0], labels)
    expected = []
    for r in stages[0].collect():
        flat = np.frombuffer(r.text.encode(), np.uint8)
        if model.score(term_counts(flat, np.array([0, len(flat)])))[0] >= 0.3:
            expected.append(r.doc_id)
    assert ids(stages[1]) == sorted(expected) and len(expected) < stages[0].count()


def test_language(stages):
    model = fit_languages(stages[1].filter(remainder(F.col("doc_id"), 5) != 0))
    assert ids(stages[2]) == sorted(r.doc_id for r in stages[1].collect() if model.decide(r.text.encode())[2])


def test_near_duplicates(stages):
    groups = simhash_duplicates(stages[2]).select("component_id").distinct()
    assert ids(stages[3]) == sorted(r.component_id for r in groups.collect())


def test_mixing(stages):
    plan = mixing_plan(stages[3])
    copies = with_copies(stages[3], plan).select("d.doc_id", "copies").collect()
    assert Counter(ids(stages[4])) == Counter({r.doc_id: r.copies for r in copies if r.copies})


def test_packing(stages):
    once = stages[4].dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text for r in once.collect()}
    pieces = stages[5].collect()
    assert {r.doc_id for r in pieces} == set(texts)
    assert sum(r.start == 0 for r in pieces) == stages[4].count()
    check(corpus_pipeline.packing(None, once, "").collect(), texts, 4096)


def test_run_equals_its_stages(spark, sf_dir, stages):
    rows = corpus_pipeline.run(spark, sf_dir)
    names = ["doc_id", "start", "length", "ids_crc32"]
    whole, stepwise = (Counter(r.doc_id for r in df.select(*names).collect() if r.start == 0) for df in (rows, stages[5]))
    assert whole == stepwise


def test_odd_rows(spark, sf_dir, odd_docs, no_docs):
    narrow = odd_docs
    for _, stage in corpus_pipeline.STAGES:
        narrow = stored(stage(spark, narrow, sf_dir), "odd")
    assert {1, 6, 9} & {r.doc_id for r in narrow.collect()}
    empty = no_docs
    for _, stage in corpus_pipeline.STAGES:
        empty = stored(stage(spark, empty, sf_dir), "empty")
    assert empty.count() == 0
