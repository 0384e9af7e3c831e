"""Hard negatives against all pairs, and the bounds and order of cells."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowtide.llm import negatives
from rowtide.llm.negatives import CellIndex, fit_codebooks, index_rows, mine_negatives


def test_cells_come_by_falling_bounds_that_hold():
    rng = np.random.default_rng(2)
    rows, queries = rng.integers(-90, 90, (600, 9)).astype(float), rng.integers(-90, 90, (20, 9)).astype(float)
    books = fit_codebooks(rows[:200], 9, 7)
    index = CellIndex(books, books.cells(rows), np.arange(600), np.zeros(600, int), rows)
    bounds = index.bounds(queries)
    for n, query in enumerate(queries):
        seen, last = [], np.inf
        for bound, (start, end) in index.visit(bounds[0][n], bounds[1][n]):
            assert bound <= last + 1e-6 and (index.rows[start:end] @ query <= bound).all()
            last = bound
            seen += index.ids[start:end].tolist()
        assert sorted(seen) == list(range(600))


def expected(ids, labels, rows, asked, k=5, least=80):
    out = []
    for a in np.flatnonzero(asked):
        scored = sorted((-int(rows[a] @ rows[c]), int(ids[c]), bool(labels[c] == labels[a])) for c in range(len(ids)) if ids[c] != ids[a])
        for minus, positive, _ in [s for s in scored if s[2]][:k]:
            score = -minus
            fits = [(-m, i) for m, i, same in scored if not same and least * score <= -100 * m <= 100 * score]
            out += [(int(ids[a]), positive, r + 1, i, score, s) for r, (s, i) in enumerate(fits[:k])]
    return sorted(out)


def table(spark, ids, labels, rows):
    data = [(int(i), int(n), [float(x) for x in v]) for i, n, v in zip(ids, labels, rows, strict=True)]
    return spark.createDataFrame(data, "vec_id long, label int, vector array<double>")


@pytest.mark.parametrize("spread,groups", [(2, 1), (60, 1), (60, 25)])
def test_negatives_equal_all_pairs(spark, monkeypatch, spread, groups):
    monkeypatch.setattr(negatives, "CELL_ROWS", 8)
    rng = np.random.default_rng(spread + groups)
    ids, labels = rng.permutation(500), rng.integers(0, 4, 500)
    rows = rng.integers(-spread, spread, (500, 13)).astype(float)
    if groups > 1:
        rows = rng.integers(-200, 200, (groups, 13)).astype(float)[rng.integers(0, groups, 500)] + rows // 8
    vectors = table(spark, ids, labels, rows).repartition(3)
    found = mine_negatives(vectors, F.col("vec_id") % 9 == 0, task_rows=90, sample=100, block_bytes=13 * 8 * 20)
    got = sorted(tuple(r) for r in found.collect())
    assert got == expected(ids, labels, rows, ids % 9 == 0) and got


def test_grouped_vectors_are_not_all_visited():
    rng = np.random.default_rng(5)
    rows = rng.integers(-300, 300, (40, 16)).astype(float)[rng.integers(0, 40, 4000)] + rng.integers(-9, 9, (4000, 16))
    books = fit_codebooks(rows[:1000], 16, 12)
    index = CellIndex(books, books.cells(rows), np.arange(4000), np.arange(4000) % 3, rows)
    bounds, visited = index.bounds(rows[:50]), 0
    for n in range(50):
        best = negatives.Best(5)
        for bound, (start, end) in index.visit(bounds[0][n], bounds[1][n]):
            if bound < best.floor:
                break
            visited += end - start
            best.take(index.rows[start:end] @ rows[n], index.ids[start:end])
    assert visited < 0.4 * 50 * 4000


def test_a_cell_of_many_rows_goes_to_several_tasks(spark):
    vectors = spark.range(2000).select("id", F.lit(1).alias("label"), F.array(F.lit(1.0), F.lit(2.0)).alias("v"))
    books = fit_codebooks(np.array([[1.0, 2.0]]), 2, 4)
    sizes = index_rows(vectors, books, 250).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 500


def test_odd_rows(spark):
    rows = [
        (0, 1, [2.0, 2.0]),
        (0, 1, [2.0, 2.0]),
        (1, 1, [5.0, 5.0]),
        (1, 1, [5.0, 5.0]),
        (2, 2, [5.0, 4.0]),
        (3, 2, [5.0, 5.0]),
        (4, 3, [5.0, 5.0]),
        (5, None, [5.0, 5.0]),
        (6, 3, None),
        (None, 3, [5.0, 5.0]),
        (7, 3, [9.0]),
        (8, 3, []),
        (9, 3, [9.0, 0.0, 7.0]),
        (10, 9, [-1.0, -1.0]),
        (11, 9, [1.0, 1.0]),
        (20, 7, [1.0, 0.0]),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, label int, vector array<double>")
    vectors = vectors.withColumns({n: F.lit("own") for n in ("id", "v", "cell", "number", "anchor", "score", "rank", "asked")})
    got = sorted(tuple(r) for r in mine_negatives(vectors, F.col("vec_id") % 10 == 0, negatives=3).collect())
    # 10's only positive has a negative score, 20 has none of its label.
    assert got == [(0, 1, 1, 3, 20, 20), (0, 1, 2, 4, 20, 20), (0, 1, 3, 2, 20, 18)]
    for nothing in (vectors.limit(0), vectors.filter("vec_id = 6"), vectors.filter("vec_id = 1")):
        found = mine_negatives(nothing, F.col("vec_id") % 10 == 0)
        assert found.count() == 0 and found.columns[0] == "anchor_id" and found.schema["rank"].dataType.typeName() == "integer"
