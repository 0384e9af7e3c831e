"""Exact top-k search and the range join against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rowtide.llm.rangejoin import near_duplicate_vectors
from rowtide.llm.topk import SEGMENTS, statistics, top_k, whole_components


def table(spark, ids, rows, name):
    data = [(int(i), [float(x) for x in v]) for i, v in zip(ids, rows, strict=True)]
    return spark.createDataFrame(data, f"vec_id long, {name} array<double>")


def test_segment_statistics_bound_products_and_distances():
    rng = np.random.default_rng(1)
    a, b = rng.integers(-90, 90, (30, 37)).astype(float), rng.integers(-90, 90, (40, 37)).astype(float)
    for segment in SEGMENTS:
        x, y = statistics(a, segment), statistics(b, segment)
        assert (x @ y.T >= a @ b.T - 1e-6).all()
        near = ((x[:, None] - y[None]) ** 2).sum(2)
        assert (near <= ((a[:, None] - b[None]) ** 2).sum(2) + 1e-6).all()


def best(ids, rows, asked, k):
    expected = []
    for q in np.flatnonzero(asked):
        scored = sorted((-int(rows[q] @ rows[c]), int(ids[c])) for c in range(len(ids)) if ids[c] != ids[q])
        expected += [(int(ids[q]), r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(expected)


@pytest.mark.parametrize("spread", [2, 200])
def test_top_k_equals_all_pairs(spark, spread):
    rng = np.random.default_rng(spread)
    ids, rows = rng.permutation(700), rng.integers(-spread, spread, (700, 19)).astype(float)
    vectors = table(spark, ids, rows, "vector").repartition(5)
    found = top_k(vectors, vectors.filter("vec_id % 7 = 0"), k=5, block_rows=30, batch_rows=100)
    got = sorted((r.query_id, r["rank"], r.id, r.score) for r in found.collect())
    assert got == best(ids, rows, ids % 7 == 0, 5)


def test_top_k_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]),
        (0, [1.0, 2.0]),
        (1, [1.0, 1.0]),
        (1, [1.0, 1.0]),
        (2, [1.0, 1.0]),
        (3, None),
        (4, [1.0, None]),
        (5, [float("nan"), 1.0]),
        (6, [float("inf"), 1.0]),
        (None, [9.0, 9.0]),
        (7, []),
        (8, [0.5, 0.001, 3.0]),
        (9, [-0.001, 0.0]),
    ]
    raw = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("x"))
    vectors = raw.withColumn("vector", whole_components(F.col("embedding"), 256))
    parts = {r.vec_id: r.vector for r in vectors.collect()}
    assert parts[8] == [128.0, 0.0, 768.0] and parts[9] == [-1.0, 0.0]
    assert parts[3] is parts[4] is parts[5] is parts[6] is None
    found = top_k(vectors, vectors.filter("vec_id % 3 = 0"), k=5).collect()
    got = {q: [(r.id, r.score) for r in found if r.query_id == q] for q in (0, 3, 6, 9)}
    assert got[0] == [(1, 196608), (2, 196608), (8, 32768), (7, 0), (9, -256)]
    assert got[3] == got[6] == [] and len(got[9]) == 5
    assert top_k(vectors.limit(0), vectors.limit(0)).count() == 0
    few = top_k(vectors.filter("vec_id IN (1, 2)"), vectors.filter("vec_id = 1"), k=5)
    assert [(r["rank"], r.id) for r in few.collect()] == [(1, 2)]


def linked(ids, rows, least):
    """Links and components by all pairs of vectors of one length."""
    n = len(ids)
    near = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            a, b = rows[i], rows[j]
            if i != j and len(a) == len(b) and a.any() and b.any():
                near[i, j] = a @ b / np.sqrt(a @ a) / np.sqrt(b @ b) >= least
    component = np.array(ids)
    while True:
        after = np.array([min([component[i], *component[near[i]]]) for i in range(n)])
        if (after == component).all():
            return near.sum(axis=1), component
        component = after


@pytest.mark.parametrize(("cell_rows", "slot_rows", "part"), [(40, 15, 7), (1000, 1000, 512), (9, 4, 3), (1000, 50, 16)])
def test_range_join_equals_all_pairs(spark, cell_rows, slot_rows, part):
    rng = np.random.default_rng(cell_rows)
    centres = rng.standard_normal((20, 6))
    rows = [c + rng.standard_normal(6) * s for c in centres for s in rng.choice([0, 0.05, 0.2, 0.4], 12)]
    rows += [rows[0], rows[0], rows[5] * 3.5, np.zeros(6), rng.standard_normal(4)]
    rows += [centres[0] + rng.standard_normal(6) * 0.01 for _ in range(60)]
    ids = rng.permutation(len(rows)) + 10
    got = near_duplicate_vectors(
        table(spark, ids, rows, "embedding").repartition(4),
        least=0.95, cell_rows=cell_rows, slot_rows=slot_rows, part=part,
    ).toPandas().set_index("vec_id")
    links, component = linked(ids, rows, 0.95)
    got = got.loc[ids]
    assert got.n_links.tolist() == links.tolist()
    assert got.component_id.tolist() == component.tolist()
    assert got.kept.tolist() == (component == ids).tolist()


def test_range_join_odd_rows(spark):
    rows = [
        (3, [1.0, 0.0]),
        (3, [1.0, 0.0]),
        (1, [2.0, 0.0]),
        (4, None),
        (5, [0.0, 0.0]),
        (6, [float("nan"), 1.0]),
        (7, [1.0, None]),
        (None, [1.0, 0.0]),
        (8, []),
        (9, [1.0, 0.0, 0.0]),
        (10, [-1.0, 0.0]),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = vectors.withColumns({c: F.lit("own") for c in ("id", "v", "h1", "cell", "n_links", "root")})
    found = sorted(
        (r.vec_id or -1, r.n_links, r.component_id, r.kept) for r in near_duplicate_vectors(vectors).collect()
    )
    assert found == [
        (-1, 0, None, False),
        (1, 2, 1, True),
        (3, 2, 1, False),
        (3, 2, 1, False),
        *((i, 0, i, True) for i in range(4, 11)),
    ]
    assert near_duplicate_vectors(vectors.limit(0)).count() == 0


def test_blocks_of_queries_are_sent_one_after_another(spark, monkeypatch):
    """No more than one block is held at a time."""
    from pyspark.core.broadcast import Broadcast

    from rowtide.llm import topk

    alive, most = [0], [0]
    send = topk._send

    def counted(block):
        alive[0] += 1
        most[0] = max(most[0], alive[0])
        return send(block)

    unpersist = Broadcast.unpersist
    monkeypatch.setattr(topk, "_send", counted)
    monkeypatch.setattr(Broadcast, "unpersist", lambda b, *a: (alive.__setitem__(0, alive[0] - 1), unpersist(b, *a))[1])
    rng = np.random.default_rng(2)
    vectors = table(spark, np.arange(200), rng.integers(-9, 9, (200, 5)).astype(float), "vector")
    assert top_k(vectors, vectors, k=2, block_rows=30).count() == 400
    assert most == [1] and alive == [0]


def test_cells_have_about_as_many_guests(spark):
    from rowtide.llm.rangejoin import _cells, _unit

    rng = np.random.default_rng(4)
    rows, pivots = _unit(rng.normal(size=(6000, 24))), _unit(rng.normal(size=(16, 24)))
    guests = [len(members) for _, members, at_home in _cells(rows, pivots, 0.32) if not at_home]
    assert max(guests) < 3 * np.median(guests)
