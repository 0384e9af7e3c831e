"""Hard negatives of labelled vectors, found through an inverted multi-index with certain bounds."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.common import stored
from rowtide.llm.vectors import matrix

SAMPLE = 16_384  # rows that the codebooks are fitted to
MOST_CODES = 256  # codes of a half at most
CELL_ROWS = 512  # rows of a cell, on average, up to that
BLOCK_BYTES = 32 << 20  # anchors that are sent to the tasks at once


@dataclass(frozen=True)
class Codebooks:
    """Centres of either half of the vectors; a row's cell is the pair of its nearest centres."""

    first: np.ndarray
    second: np.ndarray

    @property
    def width(self) -> int:
        return self.first.shape[1] + self.second.shape[1]

    def halves(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        split = self.first.shape[1]
        return rows[:, :split], rows[:, split:]

    def cells(self, rows: np.ndarray) -> np.ndarray:
        one, two = self.halves(rows)
        return nearest(one, self.first) * len(self.second) + nearest(two, self.second)


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(1) - 2 * rows @ centres.T, axis=1)


def centres(rows: np.ndarray, codes: int, rounds: int = 10) -> np.ndarray:
    """At most ``codes`` centres of the rows by k-means from distinct rows; one centre without rows."""
    known = np.unique(rows, axis=0)
    if len(known) <= codes:
        return known if len(known) else np.zeros((1, rows.shape[1]))
    found = known[np.random.default_rng(0).choice(len(known), codes, replace=False)]
    for _ in range(rounds):
        of = nearest(rows, found)
        size = np.bincount(of, minlength=codes)
        total = np.zeros_like(found)
        np.add.at(total, of, rows)
        found = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], found)
    return found


def fit_codebooks(rows: np.ndarray, width: int, codes: int) -> Codebooks:
    split = -(-width // 2)
    return Codebooks(centres(rows[:, :split], codes), centres(rows[:, split:], codes))


class CellIndex:
    """Rows by cells, with the radius of each code: how far its rows lie from the centre at most."""

    def __init__(self, books: Codebooks, cells: np.ndarray, ids, labels, rows) -> None:
        order = np.argsort(cells, kind="stable")
        self.ids, self.labels, self.rows = ids[order], labels[order], rows[order]
        found, starts = np.unique(cells[order], return_index=True)
        ends = np.append(starts[1:], len(rows))
        code = np.divmod(found, len(books.second))
        self.halves, place = [], []
        parts = zip(books.halves(self.rows), (books.first, books.second), code, strict=True)
        for half, book, codes in parts:
            used, at = np.unique(codes, return_inverse=True)
            far = np.sqrt(((half - np.repeat(book[codes], ends - starts, axis=0)) ** 2).sum(1))
            radius = np.zeros(len(used))
            np.maximum.at(radius, np.repeat(at, ends - starts), far)
            self.halves.append((book[used], radius))
            place.append(at)
        self.books = books
        self.at = dict(zip(zip(*(p.tolist() for p in place), strict=True), zip(starts, ends, strict=True), strict=True))

    def bounds(self, queries: np.ndarray) -> list[np.ndarray]:
        """For either half, the most that a row under each code can add to each query's product."""
        parts = zip(self.books.halves(queries), self.halves, strict=True)
        return [q @ c.T + np.sqrt((q**2).sum(1))[:, None] * radius for q, (c, radius) in parts]

    def visit(self, first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, tuple[int, int]]]:
        """A query's cells with rows, by falling bound: the sum of the bounds of both halves.

        A heap holds the pairs of codes that may come next. Either half's codes are in the order
        of their bounds, so the pair after it in a row comes no earlier, and a row starts after the
        one before it: each pair enters once.
        """
        one, two = np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()
        a_bound, b_bound = first[one].tolist(), second[two].tolist()
        heap = [(-a_bound[0] - b_bound[0], 0, 0)]
        while heap:
            bound, a, b = heappop(heap)
            if (cell := self.at.get((one[a], two[b]))) is not None:
                # The bound is rounded; a little more than its error is given to it.
                yield -bound + 1e-9 * (1 + abs(bound)), cell
            if b + 1 < len(two):
                heappush(heap, (-a_bound[a] - b_bound[b + 1], a, b + 1))
            if b == 0 and a + 1 < len(one):
                heappush(heap, (-a_bound[a + 1] - b_bound[0], a + 1, 0))


class Best:
    """The best ``k`` of the scores in a window from ``low`` to ``high``; equal scores by id, a pair of both once.

    ``floor`` is the lowest score that can still be among them.
    """

    def __init__(self, k: int, low: float = -np.inf, high: float = np.inf) -> None:
        self.k, self.floor, self.high = k, low, high
        self.scores, self.ids = np.zeros(0), np.zeros(0, np.int64)

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = (scores >= self.floor) & (scores <= self.high)
        if not fits.any():
            return
        scores, ids = np.concatenate([self.scores, scores[fits]]), np.concatenate([self.ids, ids[fits]])
        order = np.lexsort((ids, -scores))
        scores, ids = scores[order], ids[order]
        fresh = np.ones(len(ids), bool)
        fresh[1:] = (scores[1:] != scores[:-1]) | (ids[1:] != ids[:-1])
        self.scores, self.ids = scores[fresh][: self.k], ids[fresh][: self.k]
        if len(self.ids) == self.k:
            self.floor = max(self.floor, self.scores[-1])


@dataclass
class Anchors:
    """A block of anchors: numbers, ids, labels, vectors, and floors of their positives' scores."""

    numbers: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    floors: np.ndarray


def search_positives(index: CellIndex, anchors: Anchors, k: int) -> Iterator[tuple[int, float, Best]]:
    """The best rows of each anchor's label. Cells are visited until no further one can hold any."""
    bounds = index.bounds(anchors.rows)
    for n, number in enumerate(anchors.numbers.tolist()):
        best = Best(k, anchors.floors[n])
        for bound, (start, end) in index.visit(bounds[0][n], bounds[1][n]):
            if bound < best.floor:
                break
            fit = (index.labels[start:end] == anchors.labels[n]) & (index.ids[start:end] != anchors.ids[n])
            best.take((index.rows[start:end] @ anchors.rows[n])[fit], index.ids[start:end][fit])
        yield number, 0, best


def search_negatives(
    index: CellIndex, anchors: Anchors, windows: list[list[tuple[int, int]]], k: int
) -> Iterator[tuple[int, float, Best]]:
    """The best rows of other labels in each window of scores of each anchor.

    Cells are visited until all the anchor's windows are certain: filled with scores above all
    that is left, or all that is left lies below them.
    """
    bounds = index.bounds(anchors.rows)
    for n, number in enumerate(anchors.numbers.tolist()):
        wanted = [Best(k, low, high) for low, high in windows[n]]
        if not wanted:
            continue
        for bound, (start, end) in index.visit(bounds[0][n], bounds[1][n]):
            if bound < min(best.floor for best in wanted):
                break
            fit = (index.labels[start:end] != anchors.labels[n]) & (index.ids[start:end] != anchors.ids[n])
            scores, ids = (index.rows[start:end] @ anchors.rows[n])[fit], index.ids[start:end][fit]
            for best in wanted:
                best.take(scores, ids)
        for best in wanted:
            yield number, best.high, best


FOUND = "anchor long, window long, id long, score long"


def _found(results: Iterator[tuple[int, float, Best]]) -> Iterator[pa.RecordBatch]:
    kept = [(number, window, best) for number, window, best in results if len(best.ids)]
    sizes = [len(best.ids) for _, _, best in kept]
    none = [np.zeros(0, np.int64)]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat(np.array([n for n, _, _ in kept], np.int64), sizes)),
            pa.array(np.repeat(np.array([w for _, w, _ in kept], np.int64), sizes)),
            pa.array(np.concatenate([best.ids for _, _, best in kept] or none)),
            pa.array(np.concatenate([best.scores.astype(np.int64) for _, _, best in kept] or none)),
        ],
        ["anchor", "window", "id", "score"],
    )


def _arrays(batch: pa.RecordBatch | pa.Table, width: int):
    return (
        batch.column("id").to_numpy(),
        batch.column("label").to_numpy(),
        matrix(batch.column("v"), width)[0],
    )


def _best_rows(found: DataFrame, k: int) -> DataFrame:
    """The tasks' findings, cut to ``k`` a window; Spark cuts them so before the shuffle, too."""
    place = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(place))
    return stored(ranked.filter(F.col("rank") <= k), "negatives-best")


def index_rows(rows: DataFrame, books: Codebooks, task_rows: int) -> DataFrame:
    """``rows`` by cells: tasks of about ``task_rows`` rows, which hold neighbouring cells, a cell of many
    rows in several of them."""

    def cells(batches):
        for batch in batches:
            cell = books.cells(matrix(batch.column("v"), books.width)[0])
            yield batch.append_column("cell", pa.array(cell, pa.int64()))

    coded = rows.mapInArrow(cells, rows.schema.simpleString()[7:-1] + ",cell:bigint")
    tasks = max(1, -(-rows.count() // task_rows))
    # The rows' own order in their files parts rows that share a cell.
    return coded.withColumn("nth", F.monotonically_increasing_id()).repartitionByRange(tasks, "cell", "nth").drop("nth")


def mine_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    *,
    ident: str = "vec_id",
    label: str = "label",
    vector: str = "vector",
    positives: int = 5,
    negatives: int = 5,
    least_percent: int = 80,
    task_rows: int = 32_768,
    sample: int = SAMPLE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The hardest negatives of each anchor and positive: ``anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score``.

    ``vectors`` has ids (long), labels and vectors of whole numbers as doubles, whose inner
    products, the scores, must stay below 2^53. Anchors are the rows with ``is_anchor``. An anchor's
    positives are the rows of other ids with its label of the highest scores; a positive's
    negatives are those with other labels of the highest scores from ``least_percent`` of the positive's
    score up to that score itself. Ties go by the smaller id; fewer are all returned.

    Rows with a null id, label or vector take no part. Shorter vectors count as filled up with zeros.
    Rows that repeat an id, a label and a vector are one anchor and one candidate; different rows of an id
    are anchors of their own, and candidates of their own where their scores differ. An empty table
    gives an empty result. Other columns of ``vectors``, of whatever name, are not read.

    The codebooks are fitted to the ``sample`` rows whose ids have the smallest hashes; all rows are
    indexed, and the result is exact, whatever the codebooks. A task holds ``task_rows`` rows of
    neighbouring cells and gives at most five rows for an anchor or a window. Anchors
    are sent in blocks of ``block_bytes``, one block after another: each block's result is written, and the
    block let go, before the next is sent.
    """
    rows = vectors.select(
        F.col(ident).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("v"),
        F.coalesce(is_anchor, F.lit(False)).alias("asked"),
    ).dropna(subset=["id", "label", "v"])
    spark = rows.sparkSession
    asked = rows.filter("asked").select("id", "label", "v").distinct().withColumn("number", F.monotonically_increasing_id())
    asked = stored(asked, "negatives-anchors")
    few = rows.select("id", "label", "v").orderBy(F.xxhash64("id"), "id", "label").limit(sample).toArrow()
    count, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    known = _arrays(few, width) if few.num_rows else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, width)))
    codes = int(min(MOST_CODES, max(1, round((count / CELL_ROWS) ** 0.5))))
    books = fit_codebooks(known[2], width, codes)
    index = stored(index_rows(rows.select("id", "label", "v"), books, task_rows), "negatives-index")

    block_rows = max(1, block_bytes // (8 * max(width, 1)))
    blocks = max(1, -(-asked.count() // block_rows))
    of = F.pmod(F.xxhash64("number"), F.lit(blocks))
    results = []
    for block in range(blocks):
        part = asked.filter(of == block).toArrow()
        if not part.num_rows:
            continue
        ids, labels, values = _arrays(part, width)
        anchors = Anchors(part.column("number").to_numpy(), ids, labels, values, floors(known, ids, labels, values, positives))
        sent = spark.sparkContext.broadcast((books, anchors))
        first = _search(index, sent, lambda i, a, _: search_positives(i, a, positives))
        best = _best_rows(first, positives).drop("window")
        sent.unpersist()

        windows = _windows(best.select("anchor", "score").distinct().toArrow(), anchors, least_percent)
        sent = spark.sparkContext.broadcast((books, anchors, windows))
        second = _search(index, sent, lambda i, a, w: search_negatives(i, a, w, negatives))
        hard = _best_rows(second, negatives)
        sent.unpersist()
        results.append(
            best.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
            .join(hard.withColumnRenamed("window", "positive_score"), ["anchor", "positive_score"])
            .join(asked.select(F.col("number").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
            .select(
                "anchor_id",
                "positive_id",
                "rank",
                F.col("id").alias("negative_id"),
                "positive_score",
                F.col("score").alias("negative_score"),
            )
        )
    if not results:
        empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return spark.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, results)


def floors(known, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, k: int, part: int = 1024) -> np.ndarray:
    """For each anchor, a score that its ``k``-th positive reaches at least: that of the sampled rows."""
    found = np.full(len(ids), -np.inf)
    for low in range(0, len(ids), part):
        scores = rows[low : low + part] @ known[2].T
        for n, row in enumerate(scores, low):
            best = Best(k)
            fit = (known[1] == labels[n]) & (known[0] != ids[n])
            best.take(row[fit], known[0][fit])
            found[n] = best.floor
    return found


def _windows(scores: pa.Table, anchors: Anchors, least_percent: int) -> list[list[tuple[int, int]]]:
    """Each anchor's windows: whole scores from the share of each positive's score up to that."""
    place = {number: n for n, number in enumerate(anchors.numbers.tolist())}
    windows = [[] for _ in place]
    for number, high in zip(scores.column("anchor").to_pylist(), scores.column("score").to_pylist(), strict=True):
        low = -(-least_percent * high // 100)
        if low <= high:
            windows[place[number]].append((low, high))
    return windows


def _search(index: DataFrame, sent, find) -> DataFrame:
    def search(batches):
        books, anchors, *windows = sent.value
        parts = [(*_arrays(batch, books.width), batch.column("cell").to_numpy()) for batch in batches if batch.num_rows]
        if parts:
            ids, labels, rows, cells = (np.concatenate(column) for column in zip(*parts, strict=True))
            yield from _found(find(CellIndex(books, cells, ids, labels, rows), anchors, *windows or [None]))

    return index.mapInArrow(search, FOUND)
