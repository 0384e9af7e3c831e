"""Near-duplicate vectors: an exact range join in cells around pivots."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.llm.common import stored
from rowtide.llm.components import components
from rowtide.llm.vectors import matrix, usable

_SLACK = 1e-6  # more than the rounding of distances


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of unit vectors, from their cosines."""
    return np.sqrt(np.maximum(2 - 2 * (rows @ pivots.T), 0))


def _cells(rows: np.ndarray, pivots: np.ndarray, radius: float) -> Iterator[tuple[int, np.ndarray, bool]]:
    """The home cell of each row and the other cells whose points may lie within the radius and are
    joined there.

    A row's home is its nearest pivot. A point of another pivot's cell is nearer to that pivot
    than to the row's; by the triangle inequality it is then at least half the difference of the
    row's two distances away. In Euclidean space the bisecting plane tells more: at least the
    difference of the squares over twice the pivots' distance. The larger of both bounds counts.
    """
    far = _distances(rows, pivots)
    home = far.argmin(axis=1)
    near = far[np.arange(len(rows)), home]
    between = np.maximum(_distances(pivots, pivots), 1e-12)
    for cell in range(len(pivots)):
        yield cell, np.flatnonzero(home == cell), True
        bound = np.maximum(
            (far[:, cell] - near) / 2, (far[:, cell] ** 2 - near**2) / (2 * between[home, cell])
        )
        # Each pair of cells is joined in one of them: that of the lower number if their sum is
        # even, else the other. So all cells have about as many guests.
        here = np.where(home > cell, (home + cell) % 2 == 0, (home + cell) % 2 == 1) & (home != cell)
        yield cell, np.flatnonzero(here & (bound <= radius + _SLACK)), False


def _placed(distinct: DataFrame, pivots: np.ndarray, width: int, radius: float, guests: bool) -> DataFrame:
    """Rows with the cell they are at home in and, if asked for, those they are guests in."""
    sent = SparkSession.getActiveSession().sparkContext.broadcast(pivots)

    def place(batches):
        pivots = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, _ = matrix(batch.column("v"), width)
            for cell, members, at_home in _cells(_unit(rows), pivots, radius):
                if len(members) and (at_home or guests):
                    n = len(members)
                    yield pa.RecordBatch.from_arrays(
                        [
                            *(batch.column(c).take(pa.array(members)) for c in range(batch.num_columns)),
                            pa.array(np.full(n, cell, np.int32)),
                            pa.array(np.full(n, at_home)),
                        ],
                        [*batch.schema.names, "cell", "at_home"],
                    )

    schema = "h1 long, h2 long, id long, copies long, v array<double>, cell int, at_home boolean"
    return distinct.select("h1", "h2", "id", "copies", "v").mapInArrow(place, schema)


def _dealt(distinct: DataFrame, pivots: np.ndarray, width: int, radius: float, slot_rows: int) -> DataFrame:
    """Rows by cell: at home in one of the cell's slots, and a guest in every slot it must meet.

    The number of slots follows the cell's rows at home, which are counted first; one number for
    each pivot comes to the driver.
    """
    home = _placed(distinct, pivots, width, radius, guests=False)
    sizes = dict(home.groupBy("cell").count().collect())
    slots = F.array(*(F.lit(max(1, -(-sizes.get(c, 0) // slot_rows))) for c in range(len(pivots))))
    placed = _placed(distinct, pivots, width, radius, guests=True).withColumn("slots", F.get(slots, "cell"))
    own = F.pmod(F.xxhash64("h1", "h2", F.lit("slot")), F.col("slots")).cast("int")
    # A row at home meets the lower slots of its cell as a guest; a guest meets them all.
    last = F.when(F.col("at_home"), own).otherwise(F.col("slots") - 1)
    return placed.select("*", F.explode(F.sequence(F.lit(0), last)).alias("slot")).withColumn(
        "guest", ~F.col("at_home") | (F.col("slot") != own)
    )


class _Group:
    """The rows at home in one slot of a cell, and what their links join."""

    def __init__(self, keys: np.ndarray, ids, copies, rows, lengths, least: float) -> None:
        self.keys, self.ids, self.copies = keys, ids, copies
        self.rows, self.lengths, self.least = rows, lengths, least
        self.links = np.zeros(len(ids), np.int64)
        self.label = np.arange(len(ids))

    def _near(self, rows, lengths) -> np.ndarray:
        width = max(rows.shape[1], self.rows.shape[1])
        if rows.shape[1] < width:
            rows = np.pad(rows, ((0, 0), (0, width - rows.shape[1])))
        own = np.pad(self.rows, ((0, 0), (0, width - self.rows.shape[1])))
        near = rows @ own.T >= self.least
        if lengths.min(initial=0) != self.lengths.max(initial=0) or len(set(self.lengths)) > 1:
            near &= lengths[:, None] == self.lengths[None, :]
        return near

    def _merge(self, row: np.ndarray) -> int | None:
        """Joins the rows at home that are marked; their common label."""
        labels = np.unique(self.label[row])
        if not len(labels):
            return None
        for other in labels[1:]:
            self.label[self.label == other] = labels[0]
        return int(labels[0])

    def at_home(self, part: int) -> None:
        """Links among the rows at home."""
        for low in range(0, len(self.ids), part):
            high = min(low + part, len(self.ids))
            near = self._near(self.rows[low:high], self.lengths[low:high])
            near[np.arange(high - low), np.arange(low, high)] = False
            self.links[low:high] += near @ self.copies
            for i in np.flatnonzero(near.any(axis=1)):
                near[i, low + i] = True
                self._merge(near[i])

    def guests(self, ids, copies, rows, lengths) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """The guests' links to rows at home, and a link from each to one of what it joins."""
        near = self._near(rows, lengths)
        self.links += copies @ near
        edges = []
        for i in np.flatnonzero(near.any(axis=1)):
            label = self._merge(near[i])
            edges.append((int(ids[i]), int(self.ids[label])))
        return near @ self.copies, edges

    def own_edges(self) -> list[tuple[int, int]]:
        joined = np.flatnonzero(self.label != np.arange(len(self.ids)))
        return [(int(self.ids[i]), int(self.ids[self.label[i]])) for i in joined]


_SCHEMA = pa.schema(
    [
        ("h1", pa.int64()),
        ("h2", pa.int64()),
        ("n", pa.int64()),
        ("a", pa.int64()),
        ("b", pa.int64()),
    ]
)


def _counts(keys: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
    some = links > 0
    n = int(some.sum())
    return pa.RecordBatch.from_arrays(
        [pa.array(keys[some, 0]), pa.array(keys[some, 1]), pa.array(links[some]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())],
        schema=_SCHEMA,
    )


def _edges(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    n = len(edges)
    none = pa.nulls(n, pa.int64())
    a, b = (pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1))
    return pa.RecordBatch.from_arrays([none, none, none, a, b], schema=_SCHEMA)


def _joined(dealt: DataFrame, width: int, least: float, part: int) -> DataFrame:
    """Links of each slot of each cell: counts by row, and edges that join what links join.

    Rows come sorted, those at home first; they are bounded by the slot and kept, the guests are
    streamed past them. A slot gives at most one count for each row at home and guest and one edge
    for each, however many links there are.
    """

    def join(batches):
        group, place, home = None, None, []

        def close():
            if group is not None:
                yield _counts(group.keys, group.links)
                yield _edges(group.own_edges())

        def open_group():
            table = pa.Table.from_batches(home)
            rows, lengths = matrix(table.column("v"), width)
            made = _Group(
                np.column_stack([table.column("h1").to_numpy(), table.column("h2").to_numpy()]),
                table.column("id").to_numpy(),
                table.column("copies").to_numpy(),
                _unit(rows),
                lengths,
                least,
            )
            made.at_home(part)
            return made

        for batch in batches:
            cell, slot = batch.column("cell").to_numpy(), batch.column("slot").to_numpy()
            guest = batch.column("guest").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.diff(cell) | np.diff(slot) | (guest[1:] != guest[:-1])) + 1
            cuts = [0, *edges.tolist(), batch.num_rows]
            for low, high in zip(cuts, cuts[1:], strict=False):
                if low == high:
                    continue
                piece = batch.slice(low, high - low)
                if place != (cell[low], slot[low]):
                    if home:
                        group, home = open_group(), []
                    yield from close()
                    group, place = None, (cell[low], slot[low])
                if not guest[low]:
                    home.append(piece)
                    continue
                if home:
                    group, home = open_group(), []
                if group is None:
                    continue  # nobody is at home here
                for start in range(0, piece.num_rows, part):
                    some = piece.slice(start, part)
                    rows, lengths = matrix(some.column("v"), width)
                    links, found = group.guests(
                        some.column("id").to_numpy(), some.column("copies").to_numpy(), _unit(rows), lengths
                    )
                    keys = np.column_stack([some.column("h1").to_numpy(), some.column("h2").to_numpy()])
                    yield _counts(keys, links)
                    yield _edges(found)
        if home:
            group = open_group()
        yield from close()

    columns = ("cell", "slot", "guest", "h1", "h2", "id", "copies", "v")
    ordered = dealt.select(*columns).repartition("cell", "slot").sortWithinPartitions("cell", "slot", "guest")
    return ordered.mapInArrow(join, "h1 long, h2 long, n long, a long, b long")


def near_duplicate_vectors(
    vectors: DataFrame,
    *,
    ident: str = "vec_id",
    vector: str = "embedding",
    least: float = 0.95,
    cell_rows: int = 8192,
    slot_rows: int = 16_384,
    most_pivots: int = 1024,
    part: int = 512,
    seed: int = 0,
) -> DataFrame:
    """One row for each vector: its id, ``n_links, component_id, kept``.

    Vectors of one length are linked if their cosine in double precision is at least ``least``.
    ``n_links`` counts the other vectors linked directly, ``component_id`` is the smallest id that links lead
    to. Null and zero vectors, such as hold null or non-finite components, and rows without an id
    link with nothing; a row without an id has no component and is not kept. Rows that repeat an id are
    vectors of their own, which share its component. Other columns are not read.

    Equal vectors are joined as one with a number of copies. Pivots, a seeded sample bounded by
    ``most_pivots``, partition the rest; the triangle inequality sets into which other cells a vector
    is copied. A cell with more than ``slot_rows`` rows is cut into slots whose pairs are joined
    separately, so no group is gathered in one task.
    """
    rows = vectors.select(F.col(ident).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    sound = usable(F.col("v")) & F.exists("v", lambda x: x != 0) & F.col("id").isNotNull()
    hashed = rows.withColumns(
        {
            "h1": F.when(sound, F.xxhash64("v")),
            "h2": F.when(sound, F.xxhash64(F.lit(seed), "v")),
        }
    )
    distinct = stored(
        hashed.filter("h1 IS NOT NULL")
        .groupBy("h1", "h2")
        .agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("v").alias("v")),
        "vectors",
    )
    count, width = distinct.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    pivots = _pivots(distinct, count, width, cell_rows, most_pivots, seed)
    # A cosine of at least ``least`` is a distance of at most the radius.
    radius = float(np.sqrt(max(2 - 2 * least, 0)))
    dealt = _dealt(distinct, pivots, width, radius, slot_rows)
    links = stored(_joined(dealt, width, least, part), "vector-links")
    sums = links.filter("n IS NOT NULL").groupBy("h1", "h2").agg(F.sum("n").alias("n"))
    roots = components(links.filter("a IS NOT NULL").select("a", "b"))
    result = stored(
        distinct.select("h1", "h2", "id", "copies")
        .join(sums, ["h1", "h2"], "left")
        .join(roots.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "h1",
            "h2",
            (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "id").alias("component_id"),
        ),
        "vector-classes",
    )
    return hashed.select("id", "h1", "h2").join(result, ["h1", "h2"], "left").select(
        F.col("id").alias(ident),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"),
    )


def _pivots(distinct, count: int, width: int, cell_rows: int, most: int, seed: int) -> np.ndarray:
    """Unit vectors of a bounded sample, chosen by hash."""
    wanted = min(most, max(1, -(-count // cell_rows)))
    order = F.xxhash64("h1", "h2", F.lit(seed))
    chosen = distinct.select("v", order.alias("o"), "h1").orderBy("o", "h1").limit(wanted).select("v").toArrow()
    if not chosen.num_rows:
        return np.zeros((1, max(width, 1)))
    return _unit(matrix(chosen.column("v"), width)[0])
