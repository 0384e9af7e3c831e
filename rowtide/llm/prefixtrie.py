"""The trie of conversation prefixes, out of padded matrices of turn ids."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import stored
from rowtide.session import scratch

DIGEST = 16  # bytes that stand for a turn
BLOCK_CELLS = 1 << 19  # cells of a matrix, unless one conversation has more
SHARD_TURNS = 4 << 20
LEAST_SHARD_TURNS = 1 << 14
CHUNK_IDS = 512  # ids in a row of text that is hashed later
NOTHING = hashlib.sha256(b"").hexdigest()

# What tasks give of the trie, by kind. "whole": a node. "below": a node but for the smallest
# conversation of its parent. "piece": what a block adds to the node named by the key.
# "ends": ids, as text, of conversations that end at the node named by the key. "first", "last": the
# shard's first and last row, ids in the key and sizes in the parent's.
NODES = (
    "kind string, part int, place long, key binary, parent_key binary, conv_id long, depth long, "
    "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"
)
_ARROW = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
TYPES = {name: _ARROW[kind] for name, kind in (column.split() for column in NODES.split(", "))}
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends")


def turns_of(rows: DataFrame, ident: str, turn: str, role: str, text: str) -> DataFrame:
    """Each conversation's turns in order: ``conv_id, turns`` (an array of ``id`` and ``size``).

    A turn is known by the MD5 of its role and text, with the role's length before them; its size is
    the text's code points. Only these, not the text, are shuffled. Turns of one number go by the MD5.
    """
    by, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(by).cast("string"), F.lit(":"), by, said)))
    one = F.struct(F.col(turn).alias("turn"), digest.alias("id"), F.length(said).alias("size"))
    return (
        rows.select(F.col(ident).cast("long").alias("conv_id"), one.alias("one"))
        .filter("conv_id IS NOT NULL")
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("one")).alias("turns"))
        .select("conv_id", F.transform("turns", lambda t: F.struct(t["id"], t["size"])).alias("turns"))
    )


def rebuilt(conversations: DataFrame, base: Column, heads: Column, most: int) -> DataFrame:
    """Conversations whose first ``heads`` turns, at most ``most``, are those of the conversation ``base``."""
    wanted = conversations.select(base.alias("base")).distinct()
    first = conversations.select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    head = F.coalesce(F.slice("head", F.lit(1), heads), F.slice("turns", 1, 0))
    own = F.slice("turns", heads + 1, F.size("turns"))
    return (
        conversations.withColumns({"base": base, "heads": heads})
        .join(first.join(wanted, "base", "left_semi"), "base", "left")
        .select("conv_id", F.concat(head, own).alias("turns"))
    )


@dataclass
class Row:
    """A conversation: its turn ids one after another, and the sizes of its turns."""

    ids: bytes
    sizes: np.ndarray

    def keys(self, depth: int) -> list[bytes]:
        """Names of its prefixes of no turn to ``depth`` turns."""
        state = hashlib.md5()
        found = [state.digest()]
        for n in range(depth):
            state.update(self.ids[n * DIGEST : (n + 1) * DIGEST])
            found.append(state.digest())
        return found

    def shared(self, other: Row) -> int:
        """How many first turns two rows have in common."""
        n = min(len(self.sizes), len(other.sizes))
        one, two = (np.frombuffer(row.ids, np.uint64, 2 * n).reshape(n, 2) for row in (self, other))
        apart = np.flatnonzero((one != two).any(axis=1))
        return int(apart[0]) if len(apart) else n


class Output:
    """Rows of ``NODES``, gathered column by column."""

    def __init__(self, part: int) -> None:
        self.part, self.parts = part, defaultdict(list)

    def add(self, kind: str, **values) -> None:
        rows = next(len(v) for v in values.values() if v is not None and not np.isscalar(v))
        for name, of in TYPES.items():
            value = {"kind": kind, "part": self.part, **values}.get(name)
            if value is None or np.isscalar(value):
                self.parts[name].append(pa.repeat(pa.scalar(value, of), rows))
            else:
                self.parts[name].append(pa.array(value, of))

    def batch(self) -> pa.RecordBatch:
        arrays = [pa.concat_arrays(self.parts[n]) if n in self.parts else pa.array([], t) for n, t in TYPES.items()]
        return pa.RecordBatch.from_arrays(arrays, list(TYPES))


def correction(before: Row, after: Row, out: Output) -> None:
    """What neighbouring blocks both count of the nodes on either side of their border, taken back.

    Such a node is a distinct one in both blocks, and in both a child of its parent. If the first
    block ends with just these turns, their node is childless there, whatever follows.
    """
    depth = before.shared(after)
    keys, steps = before.keys(depth), np.arange(depth + 1)
    sizes = np.append(before.sizes[:depth], 0).astype(np.int64)
    below = sizes[::-1].cumsum()[::-1]  # sizes of the common turns from a step on
    out.add(
        "piece",
        key=keys,
        parent_key=[None, *keys[:-1]],
        depth=steps,
        n_convs=0,
        n_children=-(steps < depth).astype(np.int64),
        n_leaves=-int(len(before.sizes) == depth),
        saved_tokens=below[np.maximum(steps - 1, 0)],
    )


def block_nodes(convs: np.ndarray, rows: list[Row], least: int, place: int, out: Output) -> tuple[Row, Row, int]:
    """Adds a block's nodes to ``out``; gives its first and last row, and the place after its last ends.

    The block is a matrix of turn ids, a conversation a row, filled up. ``least`` is the
    smallest conversation of the table. Nodes on the paths of the first and the last row may go on in other
    blocks and are given as pieces; all others are whole.
    """
    lengths = np.array([len(row.sizes) for row in rows])
    n, width = len(rows), max(int(lengths.max()), 1)
    known = np.arange(width) < lengths[:, None]
    turns, size = np.zeros((n, width, 2), np.uint64), np.zeros((n, width), np.int64)
    turns[known] = np.frombuffer(b"".join(row.ids for row in rows), ">u8").reshape(-1, 2)
    size[known] = np.concatenate([row.sizes for row in rows])
    columns = ((turns[:, k, 1], turns[:, k, 0], known[:, k]) for k in reversed(range(width)))
    order = np.lexsort([convs, *(key for column in columns for key in column)])
    convs, lengths, known, turns, size = convs[order], lengths[order], known[order], turns[order], size[order]
    first, last = rows[order[0]], rows[order[-1]]

    # A row that differs from the one before it at a turn is of other nodes at all later ones, too.
    change = np.ones((n, width), bool)
    change[1:] = (turns[1:] != turns[:-1]).any(axis=2) | (known[1:] != known[:-1])
    np.logical_or.accumulate(change, axis=1, out=change)
    fresh = change & known
    again = np.where(known & ~fresh, size, 0)[:, ::-1].cumsum(axis=1)[:, ::-1]
    leaf = change[:, -1].copy()
    leaf[0] = True
    distinct = np.flatnonzero(leaf)
    ahead, length = distinct[1:], lengths[distinct[:-1]]
    longer = (lengths[ahead] > length) & ((length == 0) | ~change[ahead, np.maximum(length - 1, 0)])
    leaf[distinct[:-1][longer]] = False

    paths = [row.keys(len(row.sizes)) for row in (first, last)]
    pieces, texts = defaultdict(list), defaultdict(list)
    parents, path_above = np.full(n, least), np.full(n, -1)
    for depth in range(width + 1):
        bounds = np.flatnonzero(change[:, depth - 1]) if depth else np.zeros(1, np.int64)
        members = np.diff(np.append(bounds, n))
        conv = np.minimum.reduceat(convs, bounds)
        ended = np.add.reduceat((lengths == depth).astype(np.int64), bounds)
        facts = {
            "conv_id": conv,
            "n_convs": members,
            "n_children": np.add.reduceat(fresh[:, depth].astype(np.int64), bounds) if depth < width else 0 * members,
            "n_leaves": np.add.reduceat(leaf.astype(np.int64), bounds),
            "saved_tokens": np.add.reduceat(again[:, max(depth - 1, 0)], bounds),
        }
        node = lengths[bounds] >= depth
        path = np.full(len(bounds), -1)
        path[-1], path[0] = (1 if len(last.sizes) >= depth else path[-1]), (0 if len(first.sizes) >= depth else path[0])

        inside = np.flatnonzero(node & (path < 0))
        ends = np.full(len(bounds), NOTHING, object)
        for b in inside[ended[inside] > 0]:
            ends[b] = ids_hash(convs[bounds[b] : bounds[b] + ended[b]])
        above = path_above[bounds]
        for kind, some in (("whole", inside[above[inside] < 0]), ("below", inside[above[inside] >= 0])):
            if len(some):
                out.add(
                    kind,
                    depth=depth,
                    parent_conv_id=parents[bounds[some]] if kind == "whole" else None,
                    parent_key=[paths[p][depth - 1] for p in above[some]] if kind == "below" else None,
                    ends=ends[some],
                    **{name: values[some] for name, values in facts.items()},
                )
        for b in np.flatnonzero(path >= 0):
            key = paths[path[b]][depth]
            pieces["key"].append(key)
            pieces["parent_key"].append(paths[path[b]][depth - 1] if depth else None)
            pieces["depth"].append(depth)
            for name, values in facts.items():
                pieces[name].append(int(values[b]))
            for start in range(bounds[b], bounds[b] + ended[b], CHUNK_IDS):
                texts["key"].append(key)
                texts["ends"].append(as_text(convs[start : min(start + CHUNK_IDS, bounds[b] + ended[b])]))
        if depth:  # the root's smallest conversation is known already
            parents, path_above = np.repeat(conv, members), np.repeat(path, members)
    out.add("piece", **pieces)
    if texts:
        out.add("ends", place=place + np.arange(len(texts["key"])), **texts)
    return first, last, place + len(texts["key"])


def as_text(convs: np.ndarray) -> str:
    return ",".join(map(str, convs.tolist()))


def ids_hash(convs: np.ndarray) -> str:
    return hashlib.sha256(as_text(convs).encode()).hexdigest()


def shard_nodes(least: int, block_cells: int):
    """The function that turns a shard's rows, in order, into rows of ``NODES``."""

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, edges = TaskContext.get().partitionId(), 0, []
        for convs, rows in blocks(batches, block_cells):
            out = Output(part)
            first, last, place = block_nodes(convs, rows, least, place, out)
            if edges:
                correction(edges[1], first, out)
            edges = [edges[0] if edges else first, last]
            yield out.batch()
        if edges:
            out = Output(part)
            for kind, row in zip(("first", "last"), edges, strict=True):
                out.add(kind, key=[row.ids], parent_key=[row.sizes.astype(np.int64).tobytes()])
            yield out.batch()

    return nodes


def blocks(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[tuple[np.ndarray, list[Row]]]:
    """Rows in blocks of at most ``cells`` cells; a conversation of more turns is a block of its own."""
    convs, rows, width = [], [], 0
    for batch in batches:
        sizes = batch.column("sizes")
        flat, starts = sizes.flatten().to_numpy(), np.concatenate([[0], np.cumsum(sizes.value_lengths().to_numpy())])
        for n, (conv, ids) in enumerate(zip(batch.column("conv_id").to_pylist(), batch.column("ids").to_pylist(), strict=True)):
            row = Row(ids, flat[starts[n] : starts[n + 1]])
            wider = max(width, len(row.sizes))
            if rows and (len(rows) + 1) * wider > cells:
                yield np.array(convs), rows
                convs, rows, wider = [], [], len(row.sizes)
            convs.append(conv)
            rows.append(row)
            width = wider
    if rows:
        yield np.array(convs), rows


def borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections between shards, out of the last row of one and the first row of the next."""
    for batch in batches:
        out = Output(0)
        for pair in batch.to_pylist():
            rows = [Row(pair[f"{n}_ids"], np.frombuffer(pair[f"{n}_sizes"], np.int64)) for n in ("last", "first")]
            correction(*rows, out)
        yield out.batch()


def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each key's texts, one after another as they come, joined by commas."""
    key, state = None, None
    for batch in batches:
        done = []
        for now, text in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            if now == key:
                state.update(b"," + text.encode())
                continue
            if key is not None:
                done.append((key, state.hexdigest()))
            key, state = now, hashlib.sha256(text.encode())
        yield _hashed(done)
    if key is not None:
        yield _hashed([(key, state.hexdigest())])


def _hashed(done: list[tuple[bytes, str]]) -> pa.RecordBatch:
    arrays = [pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())]
    return pa.RecordBatch.from_arrays(arrays, ["key", "ends"])


def prefix_trie(
    conversations: DataFrame,
    *,
    ident: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    base: Column | None = None,
    heads: Column | None = None,
    most_heads: int = 5,
    shard_turns: int = SHARD_TURNS,
    block_cells: int = BLOCK_CELLS,
) -> DataFrame:
    """The trie of all conversations' first turns, a row for each node: ``conv_id, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256``.

    ``conversations`` has a row for each turn. A node is a distinct sequence of first turns, by role and
    text, and is named by its ``depth`` and its smallest conversation; the root, without turns, has all.
    ``base`` and ``heads``, expressions of ``conv_id``, have the first ``heads`` turns of each conversation, at most
    ``most_heads``, replaced by those of the conversation ``base`` (by none, if that is not there).
    ``n_leaves`` counts the childless nodes below a node and itself, ``saved_tokens`` adds up over them the
    code points of a node's last turn times its conversations but one, and ``ends_sha256`` hashes the ids,
    in ascending order and joined by commas, of the conversations that end at the node.

    Conversations are sorted by their turns over all shards, and by id where they are equal, so a
    group of copies is spread over as many shards as it fills, and the nodes of a shard are whole but
    for those on the paths of its first and last rows. Those are added up by their names; what
    neighbours count twice is taken back by corrections of as many rows as the turns they share.
    A conversation is a row of its turns' 16-byte ids, held by one task; a matrix has at
    most ``block_cells`` cells. The ids that end at one node are hashed by one task, which reads
    them as rows of ``CHUNK_IDS`` in order and holds one Arrow batch: a SHA-256 has no parts.

    Rows with a null id are left out. A null turn comes first, a null role or text is empty; turns of
    one number go by the MD5 of role and text, and rows that repeat are turns of their own. Of an empty table
    there is no node. Other columns, of whatever name, are not read.
    """
    known = turns_of(conversations, ident, turn, role, text)
    if base is not None:
        known = rebuilt(stored(known, "trie-turns"), base, F.lit(0) if heads is None else heads, most_heads)
    ids = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), ""))
    rows = stored(known.select("conv_id", ids.alias("ids"), F.col("turns.size").alias("sizes")), "trie-rows")
    spark = rows.sparkSession
    turns, least = rows.agg(F.sum(F.size("sizes") + 1), F.min("conv_id")).first()
    turns, usual = turns or 0, int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(-(-turns // shard_turns), min(-(-turns // LEAST_SHARD_TURNS), usual), 1)

    path = scratch(spark, "trie-nodes")
    sharded = rows.repartitionByRange(shards, "ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    sharded.mapInArrow(shard_nodes(least or 0, block_cells), NODES).write.partitionBy("kind").parquet(path)
    found = spark.read.schema(NODES).parquet(path)
    of = {kind: found.filter(F.col("kind") == kind) for kind in ("whole", "below", "piece", "ends", "first", "last")}

    # The numbers of the shards that have rows; each is followed by the next.
    parts = [r[0] for r in of["first"].select("part").orderBy("part").collect()]
    pairs = spark.createDataFrame(list(zip(parts, parts[1:], strict=False)), "part int, after int")
    last = of["last"].select("part", F.col("key").alias("last_ids"), F.col("parent_key").alias("last_sizes"))
    first = of["first"].select(F.col("part").alias("after"), F.col("key").alias("first_ids"), F.col("parent_key").alias("first_sizes"))
    between = pairs.join(last, "part").join(first, "after").mapInArrow(borders, NODES)

    sums = (F.sum(n).alias(n) for n in ("n_convs", "n_children", "n_leaves", "saved_tokens"))
    joined = (
        of["piece"].unionByName(between)
        .groupBy("key")
        .agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent_key").alias("parent_key"), *sums)
    )
    ends = of["ends"].select("key", "part", "place", "ends").repartition("key").sortWithinPartitions("key", "part", "place")
    ends = ends.select("key", "ends").mapInArrow(hashes, "key binary, ends string")
    joined = stored(joined.join(ends, "key", "left").fillna(NOTHING, ["ends"]), "trie-borders")
    above = joined.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    return (
        of["whole"].select(*COLUMNS)
        .unionByName(of["below"].drop("parent_conv_id").join(above, "parent_key").select(*COLUMNS))
        .unionByName(joined.join(above, "parent_key", "left").select(*COLUMNS))
        .withColumnRenamed("ends", "ends_sha256")
    )
