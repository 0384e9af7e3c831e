import numpy as np
import pytest
from pyspark.sql import functions as F

from rowtide.llm.mixing import mix, mixing_plan, water_fill, with_copies, word_count


def filled(sizes, weights, budget, epochs):
    """Water-filling by bisection on the level."""
    low, high = 0.0, 1e9
    for _ in range(200):
        level = (low + high) / 2
        total = sum(min(epochs * s, w * level) for s, w in zip(sizes, weights, strict=True))
        low, high = (level, high) if total < budget else (low, level)
    return [min(epochs * s, w * high) for s, w in zip(sizes, weights, strict=True)]


@pytest.mark.parametrize("seed", range(4))
def test_water_filling(spark, seed):
    rng = np.random.default_rng(seed)
    sizes = [int(s) for s in rng.integers(1, 1000, 12) ** 2]
    weights = [float(w) for w in rng.integers(1, 9, 12)]
    rows = [(str(i), s, w) for i, (s, w) in enumerate(zip(sizes, weights, strict=True))]
    sources = spark.createDataFrame(rows, "source string, source_size long, weight double")
    got = {r.source: r.target for r in water_fill(sources, sum(sizes), 3.0).collect()}
    expected = filled(sizes, weights, sum(sizes), 3.0)
    assert [got[str(i)] for i in range(12)] == pytest.approx(expected, rel=1e-6)


def test_water_filling_beyond_all_limits(spark):
    sources = spark.createDataFrame([("a", 10, 1.0), ("b", 5, 2.0), ("c", 7, 0.0)], "source string, source_size long, weight double")
    got = {r.source: r.target for r in water_fill(sources, 1000.0, 2.0).collect()}
    assert got == {"a": 20.0, "b": 10.0, "c": 0.0}


def test_taken_comes_near_target_and_repeats_agree(spark, documents):
    docs = documents.withColumn("size", word_count(F.col("text")))
    results = []
    for buckets in (None, 1, 1000):
        plan = mixing_plan(docs, buckets=buckets)
        taken = with_copies(docs, plan).select("d.doc_id", "d.source", "d.size", "p.target", "copies")
        results.append(sorted(taken.collect()))
    assert results[0] == results[1] == results[2]
    by_source = {}
    for r in results[0]:
        own = by_source.setdefault(r.source, [r.target, 0, 0])
        own[1] += r.copies * r["size"]
        own[2] = max(own[2], r["size"])
        assert 0 <= r.copies <= 3
    for target, words, largest in by_source.values():
        assert abs(target - words) <= largest / 2 + 1e-6


def test_mix_holds_each_row_as_often_as_planned(spark, documents):
    plan = mixing_plan(documents)
    copies = {r.doc_id: r.copies for r in with_copies(documents, plan).select("d.doc_id", "copies").collect()}
    mixed = mix(documents)
    assert mixed.columns == documents.columns
    got = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert got == {i: n for i, n in copies.items() if n}


def test_a_seed_of_its_own_gives_another_choice(spark, documents):
    first, other = (sorted(r.doc_id for r in mix(documents, seed=s).select("doc_id").collect()) for s in (0, 1))
    assert first != other


def test_odd_rows(spark, odd_docs, no_docs):
    plan = mixing_plan(odd_docs, max_epochs=3.0)
    targets = {r.source: r for r in plan.collect()}
    assert set(targets) == {"a", "b", "c", None}
    sizes = {s: r.source_size for s, r in targets.items()}
    total = sum(sizes.values())
    expected = filled([sizes[s] for s in ("a", "b", "c", None)], [1, 2, 3, 1], total, 3)
    assert [targets[s].target for s in ("a", "b", "c", None)] == pytest.approx(expected, rel=1e-6)
    rows = with_copies(odd_docs, plan).select("d.doc_id", "copies").collect()
    assert len(rows) == odd_docs.count()
    assert len({r.copies for r in rows if r.doc_id == 1}) == 1
    assert mix(odd_docs).columns == odd_docs.columns
    assert mix(no_docs).count() == 0


def test_given_weights_and_budget(spark, documents):
    weights = spark.createDataFrame([("src1", 1.0), ("src2", 1.0)], "source string, weight double")
    plan = mixing_plan(documents, weights, budget=500.0)
    targets = {r.source: r.target for r in plan.collect()}
    assert targets["src1"] == targets["src2"] == 250.0
    assert sum(targets.values()) == 500.0


def test_texts_without_words_are_not_taken_above_the_limit(spark):
    """A source at its limit of epochs, with many empty texts: none of its documents comes more often."""
    rows = [(i, "" if i < 20 else "two words", "a") for i in range(22)]
    rows += [(100 + i, "some more words here " * 50, "b") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "source string, weight double")
    for seed in range(3):
        taken = {r.doc_id: r["count"] for r in mix(docs, weights, max_epochs=3.0, seed=seed).groupBy("doc_id").count().collect()}
        assert {taken.get(i) for i in range(22)} == {3}
    empty = docs.filter("text = ''")
    assert mix(empty, weights, max_epochs=3.0).count() == 20
