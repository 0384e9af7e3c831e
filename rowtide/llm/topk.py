"""Exact nearest rows by inner product, pruned by segment statistics from coarse to fine."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowtide.llm.common import stored
from rowtide.llm.vectors import matrix, usable

SEGMENTS = (16, 4)  # components in a segment, coarse and fine


def statistics(rows: np.ndarray, segment: int) -> np.ndarray:
    """Each segment's mean and deviation, times the root of its length.

    The squared distance of two rows of these is at most that of the vectors, and their own
    squared length is the vector's. So their inner product is at least that of the vectors.
    """
    width = -(-rows.shape[1] // segment) * segment
    filled = np.zeros((len(rows), width))
    filled[:, : rows.shape[1]] = rows
    cut = filled.reshape(len(rows), -1, segment)
    mean = cut.mean(axis=2)
    return np.concatenate([mean, cut.std(axis=2)], axis=1) * np.sqrt(segment)


@dataclass
class _Best:
    """The best scores so far of each query: scores and ids, best first, equal scores by id."""

    scores: np.ndarray
    ids: np.ndarray

    @classmethod
    def none(cls, queries: int, k: int) -> _Best:
        return cls(np.full((queries, k), -np.inf), np.full((queries, k), np.iinfo(np.int64).max))

    def take(self, first: int, query: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        """Adds candidates of queries from number ``first`` on."""
        if not len(query):
            return
        k = self.scores.shape[1]
        touched = np.unique(query)
        old = np.repeat(touched, k)
        query = np.concatenate([query, old])
        score = np.concatenate([score, self.scores[first + touched].ravel()])
        ident = np.concatenate([ident, self.ids[first + touched].ravel()])
        order = np.lexsort((ident, -score, query))
        query, score, ident = query[order], score[order], ident[order]
        fresh = np.ones(len(query), bool)
        fresh[1:] = (query[1:] != query[:-1]) | (ident[1:] != ident[:-1]) | (score[1:] != score[:-1])
        query, score, ident = query[fresh], score[fresh], ident[fresh]
        starts = np.searchsorted(query, touched)
        rank = np.arange(len(query)) - np.repeat(starts, np.diff(np.append(starts, len(query))))
        keep = rank < k
        self.scores[first + touched] = -np.inf
        self.ids[first + touched] = np.iinfo(np.int64).max
        self.scores[first + query[keep], rank[keep]] = score[keep]
        self.ids[first + query[keep], rank[keep]] = ident[keep]


class _Search:
    """A block of queries against batches of candidates."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, k: int, part: int = 512) -> None:
        self.ids, self.rows, self.part = ids, rows, part
        self.levels = [statistics(rows, s) for s in SEGMENTS]
        self.best = _Best.none(len(ids), k)

    def see(self, ids: np.ndarray, rows: np.ndarray) -> None:
        width = max(rows.shape[1], self.rows.shape[1])
        if self.rows.shape[1] < width:
            self.rows = np.pad(self.rows, ((0, 0), (0, width - self.rows.shape[1])))
            self.levels = [statistics(self.rows, s) for s in SEGMENTS]
        rows = np.pad(rows, ((0, 0), (0, width - rows.shape[1])))
        levels = [statistics(rows, s) for s in SEGMENTS]
        repeats = len(np.unique(ids)) < len(ids)
        # A few candidates first, so that there is a bound to prune the others with.
        for first, last in ((0, 64), (64, len(ids))):
            some = [level[first:last] for level in levels]
            for low in range(0, len(self.ids), self.part):
                high = min(low + self.part, len(self.ids))
                self._part(low, high, ids[first:last], rows[first:last], some, repeats)

    def _part(self, low: int, high: int, ids, rows, levels, repeats: bool) -> None:
        if not len(ids):
            return
        least = self.best.scores[low:high, -1]
        queries, candidates = np.arange(low, high), np.arange(len(ids))
        possible = self.ids[low:high, None] != ids[None, :]
        for own, other in zip(self.levels, levels, strict=True):
            bound = own[queries] @ other[candidates].T
            # The bound is rounded; a little more than its error is given to it.
            bound += 1e-9 * (1 + np.abs(bound))
            possible &= bound >= least[queries - low, None]
            queries, candidates, possible = _trim(queries, candidates, possible)
            if not len(queries):
                return
        # What survives is scored exactly; rows of whole numbers below 2^53 have exact products.
        score = self.rows[queries] @ rows[candidates].T
        possible &= score >= least[queries - low, None]
        k = self.best.scores.shape[1]
        if not repeats and len(candidates) > k:
            reached = np.partition(np.where(possible, score, -np.inf), -k, axis=1)[:, -k]
            possible &= score >= reached[:, None]
        q, c = np.nonzero(possible)
        self.best.take(low, queries[q] - low, score[q, c], ids[candidates[c]])


def _trim(queries, candidates, possible):
    """Without queries and candidates that nothing is possible for."""
    q, c = possible.any(axis=1), possible.any(axis=0)
    return queries[q], candidates[c], possible[np.ix_(q, c)]


def whole_components(vector: Column, scale: int = 256) -> Column:
    """Each component as floor(scale * x), in double precision; null if no part is taken."""
    wide = F.transform(vector.cast("array<double>"), lambda x: F.floor(F.lit(float(scale)) * x).cast("double"))
    return F.when(usable(vector), wide)


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    ident: str = "vec_id",
    vector: str = "vector",
    k: int = 5,
    block_rows: int = 32_768,
    batch_rows: int = 4096,
) -> DataFrame:
    """The ``k`` rows of the highest inner product for each query: ``query_id, rank, id, score``.

    ``vectors`` and ``queries`` have ids (long) and vectors of whole numbers as doubles; products
    must stay below 2^53. Rows of the query's own id are no candidates. Fewer candidates than
    ``k`` are all returned. Equal scores go by the smaller id. Rows with a null id or vector take no
    part, shorter vectors count as filled up with zeros, and rows that repeat an id and a score
    count once; of different vectors under a query's id each row finds candidates for that id. Without
    rows or without queries there is no result.

    Queries go through in blocks of about ``block_rows``, one after another: a block is broadcast, so
    what is broadcast is bounded by the block and the width; every task keeps only the block's best
    rows so far, which are also the bound that prunes what it reads next. All candidates are
    seen by each block, once.
    """
    rows = vectors.select(F.col(ident).cast("long").alias("id"), F.col(vector).alias("v"))
    rows = rows.filter("id IS NOT NULL AND v IS NOT NULL")
    asked = queries.select(F.col(ident).cast("long").alias("id"), F.col(vector).alias("v"))
    asked = stored(asked.filter("id IS NOT NULL AND v IS NOT NULL"), "topk-queries")
    count = asked.count()
    blocks = max(1, -(-count // block_rows))
    of = F.pmod(F.xxhash64("id", "v"), F.lit(blocks))
    found = []
    for block in range(blocks):
        # One block after another: its result is written, and it is let go, before the next is sent.
        sent = _send(asked.filter(of == block).select("id", "v").toArrow())
        found.append(stored(_block(rows, sent, k, batch_rows), "topk-parts"))
        sent.unpersist()
    # Each task sends k rows for a query at most; Spark cuts them to k again before the shuffle.
    merged = reduce(DataFrame.unionByName, found).distinct()
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        merged.withColumn("rank", F.row_number().over(place))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )


def _send(block: pa.Table):
    ids = block.column("id").to_numpy()
    values, _ = matrix(block.column("v")) if len(ids) else (np.zeros((0, 0)), None)
    return SparkSession.getActiveSession().sparkContext.broadcast((ids, values))


def _block(rows: DataFrame, sent, k: int, batch_rows: int) -> DataFrame:
    def search(batches):
        held = _Search(*sent.value, k)
        for batch in batches:
            for low in range(0, batch.num_rows, batch_rows):
                part = batch.slice(low, batch_rows)
                held.see(part.column(0).to_numpy(), matrix(part.column(1))[0])
        q, rank = np.nonzero(held.best.scores > -np.inf)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(held.ids[q], pa.int64()),
                pa.array(held.best.ids[q, rank], pa.int64()),
                pa.array(held.best.scores[q, rank].astype(np.int64), pa.int64()),
            ],
            ["query_id", "id", "score"],
        )

    return rows.mapInArrow(search, "query_id long, id long, score long")
