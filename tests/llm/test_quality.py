import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rowtide.llm import queries
from rowtide.llm.quality import (
    LETTERS,
    REPEATS,
    SHAPES,
    SLOTS,
    WORDS,
    QualityModel,
    fit_quality,
    score_quality,
    term_counts,
)


def counts_of(texts):
    flat = np.frombuffer(b"".join(texts), np.uint8)
    return term_counts(flat, np.concatenate([[0], np.cumsum([len(t) for t in texts])]))


def test_terms_are_those_of_each_text_alone():
    texts = [b"Ab ab ab!", b"", b" x", "été 12".encode(), b"one one two one"]
    together = counts_of(texts)
    for row, text in enumerate(texts):
        assert (together[row] == counts_of([text])[0]).all()
        trigrams = max(len(text) - 2, 0)
        words = re.findall(rb"\S+", text)
        assert together[row, : SHAPES + LETTERS].sum() == 2 * trigrams
        assert together[row, SHAPES + LETTERS + REPEATS :].sum() == len(words)
        for lag in (1, 2):
            same = sum(a == b for a, b in zip(words, words[lag:], strict=False))
            assert together[row, SHAPES + LETTERS + lag] == same
    assert together.shape == (5, SLOTS) and WORDS > 0


def test_equal_words_share_a_slot_wherever_they_stand():
    rows = counts_of([b"alpha beta", b"beta   gamma alpha"])[:, SHAPES + LETTERS + REPEATS :]
    assert (np.minimum(*rows)).sum() >= 2


def test_votes_are_exact_cosines():
    rng = np.random.default_rng(0)
    axes = np.linalg.qr(rng.standard_normal((SLOTS, 5)))[0].astype(np.float32)
    vectors = rng.standard_normal((40, 5)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    labels = rng.integers(0, 2, 40).astype(np.float32)
    model = QualityModel(np.ones(SLOTS, np.float32), axes, vectors, labels, 7, 2.0)
    counts = rng.integers(0, 4, (9, SLOTS)).astype(np.float32)
    for row, score in zip(counts, model.score(counts), strict=True):
        place = np.log1p(row) @ axes
        cosine = np.maximum(vectors @ place / np.linalg.norm(place), 0)
        nearest = sorted(range(40), key=lambda i: -cosine[i])[:7]
        votes = cosine[nearest] ** 2
        assert score == pytest.approx(float(votes @ labels[nearest] / votes.sum()), abs=1e-4)


def test_held_out_accuracy(spark):
    got = queries.op1_quality(spark, "/root/testdata/sf0.01").toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all()
    held = got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)
    assert (held == got.held_out).all()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    known = got[got.held_out].merge(labels, on="doc_id")
    assert ((known.score >= 0.3) == known.predicted.astype(bool)).all()
    assert (known.predicted == known.quality).mean() > 0.95
    assert known.predicted[known.quality == 1].mean() > 0.97


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 1), (9, 0), (9, 0), (6, 1), (3, 0), (3, 1), (None, 1), (2, None)],
        "doc_id long, quality int",
    )
    scored = score_quality(odd_docs, labels, rank=4)
    assert scored.columns == odd_docs.columns
    rows = scored.collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    assert {r.score for r in rows if not (r.text or "").strip() and r.text != " \t\n "} == {0.5}
    assert score_quality(no_docs, labels).count() == 0
    untaught = score_quality(odd_docs, labels.limit(0)).select(F.min("score"), F.max("score")).first()
    assert untaught == (0.5, 0.5)
    assert fit_quality(no_docs, labels).labels.shape == (0,)


def test_blocks_cover_all_rows():
    from rowtide.llm.quality import _blocks

    texts = pa.array([b"ab cd " * n for n in (1, 0, 700_000, 3)] * 3, pa.binary())
    assert sum(len(b) for b in _blocks(texts)) == 12


def test_scoring_takes_little_memory_beside_the_texts():
    from rowtide.llm.quality import _blocks

    rng = np.random.default_rng(1)
    axes, vectors = rng.standard_normal((SLOTS, 8)).astype(np.float32), rng.standard_normal((2048, 8)).astype(np.float32)
    model = QualityModel(np.ones(SLOTS, np.float32), axes, vectors, rng.integers(0, 2, 2048).astype(np.float32), 15, 8.0)
    short, long = pa.array([b"ab cd "] * 5000, pa.binary()), pa.array([b"ab cd ef " * 300] * 2000, pa.binary())
    for texts in (short, long):
        tracemalloc.start()
        scores = [model.score(counts) for counts in _blocks(texts)]
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert sum(map(len, scores)) == len(texts) and peak < 40_000_000
