"""Language-model scoring by a probabilistic suffix tree over words.

The corpus is read once and kept as blocks: documents' words as numbers into the block's own
dictionary. The top of the tree, whose size is bounded, has frequent words as symbols: counts are summed
block by block in numpy and then across blocks by Spark. Below it, contexts of whole words grow with
the corpus: every string that occurs twice counts, and contexts lengthen as long as the test and their
next words tell more. These counts, and those of all words, go back to the blocks that have
them, so neither a vocabulary nor a tree is ever held whole.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.llm import longcontexts as far
from rowtide.llm.common import FREED, stored
from rowtide.session import defaults, scratch

END = b""  # no word is empty, so this stands for the end of a text


def tokens_of(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Different words of texts in lower case (A to Z), each text's tokens as numbers of these, and its size.

    Each text has an end, which is word 0.
    """
    lower = pa.array([text.lower() for text in texts], pa.binary()).view(pa.string())
    cut = pc.ascii_split_whitespace(lower)
    ends = cut.offsets.to_numpy()
    parts = cut.values
    full = pc.not_equal(pc.binary_length(parts), 0).to_numpy(zero_copy_only=False)
    sizes = np.diff(np.append(0, np.cumsum(full))[ends]) + 1
    encoded = parts.filter(pa.array(full)).dictionary_encode()
    tokens = np.zeros(int(sizes.sum()), np.int32)
    inside = np.ones(len(tokens), bool)
    inside[np.cumsum(sizes) - 1] = False
    tokens[inside] = encoded.indices.to_numpy() + 1
    return [END, *encoded.dictionary.view(pa.binary()).to_pylist()], tokens, sizes.astype(np.int32)


# ---------------------------------------------------------------------------- blocks


def _block_schema(ident: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("ids", T.ArrayType(ident)),
            T.StructField("trains", T.BinaryType()),
            T.StructField("sizes", T.BinaryType()),
            T.StructField("tokens", T.BinaryType()),
            T.StructField("words", T.BinaryType()),
            T.StructField("counts", T.BinaryType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("learned", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
        ]
    )


class _Block:
    """Documents that are being gathered for a block."""

    def __init__(self) -> None:
        self.ids, self.trains, self.texts, self.bytes = [], [], [], 0

    def add(self, ident, train: bool, text: bytes) -> None:
        self.ids.append(ident)
        self.trains.append(train)
        self.texts.append(text)
        self.bytes += len(text) + 64

    def batch(self, block: int, ident: pa.DataType) -> pa.RecordBatch:
        words, tokens, sizes = tokens_of(self.texts)
        trains = np.array(self.trains, bool)
        counts = np.bincount(tokens[np.repeat(trains, sizes)], minlength=len(words)).astype(np.int64)
        values = {
            "block": pa.array([block], pa.int64()),
            "ids": pa.array([self.ids], pa.list_(ident)),
            "trains": pa.array([trains.tobytes()], pa.binary()),
            "sizes": pa.array([sizes.tobytes()], pa.binary()),
            "tokens": pa.array([far.packed(tokens)], pa.binary()),
            "words": pa.array([far.packed_words(words)], pa.binary()),
            "counts": pa.array([far.packed(counts)], pa.binary()),
            "n_words": pa.array([len(words)], pa.int64()),
            "learned": pa.array([int(counts.sum())], pa.int64()),
            "n_tokens": pa.array([len(tokens)], pa.int64()),
        }
        return pa.RecordBatch.from_pydict(values)


def blocks_of(
    docs: DataFrame, ident: str, text: str, train: Column, block_bytes: int
) -> tuple[DataFrame, int]:
    """The documents as a written table of blocks, of about ``block_bytes`` of text each, and its buckets.

    A block's number is that of its task and its place there; only what the committed attempt of
    a task wrote is read, so lost executors and repeated tasks leave no second copy.
    """
    narrow = docs.select(
        F.col(ident).alias("id"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text).cast("binary").alias("text")
    )
    kind = narrow.schema["id"].dataType

    def gather(batches):
        numbers = itertools.count(TaskContext.get().partitionId() << 32)
        block, arrow = _Block(), None
        for batch in batches:
            arrow = batch.schema.field(0).type
            columns = (batch.column(i) for i in range(3))
            for i, t, x in zip(*columns, strict=True):
                block.add(i.as_py(), t.as_py(), x.as_py() or b"")
                if block.bytes >= block_bytes:
                    yield block.batch(next(numbers), arrow)
                    block = _Block()
        if block.ids:
            yield block.batch(next(numbers), arrow)

    written = narrow.mapInArrow(gather, _block_schema(kind))
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * narrow.rdd.getNumPartitions())
    return _bucketed(written, "lm-blocks", buckets), buckets


def _bucketed(blocks: DataFrame, purpose: str, buckets: int) -> DataFrame:
    """Rows of blocks, written in buckets, so that answers join them where they lie, without a shuffle of theirs.

    Spark knows buckets of tables only. The table's name is dropped again at once: its files are
    outside the warehouse and stay, as those of every other step.
    """
    spark = blocks.sparkSession
    name = f"{purpose}-{uuid.uuid4().hex}".replace("-", "_")
    writer = blocks.write.format("parquet").option("path", scratch(spark, purpose)).option("compression", "zstd")
    with defaults(spark, FREED):
        writer.bucketBy(buckets, "block").saveAsTable(name)
    written = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return written


@dataclass
class _Tokens:
    """A block's columns as arrays."""

    sizes: np.ndarray
    trains: np.ndarray
    tokens: np.ndarray

    @classmethod
    def read(cls, columns: dict, row: int) -> _Tokens:
        return cls(
            np.frombuffer(columns["sizes"][row].as_buffer(), np.int32),
            np.frombuffer(columns["trains"][row].as_buffer(), bool),
            far.unpacked(columns["tokens"][row].as_py(), np.int32)[0],
        )

    @property
    def places(self) -> np.ndarray:
        """The place of each token in its text."""
        return _places(self.sizes)


def _places(sizes: np.ndarray) -> np.ndarray:
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


# ---------------------------------------------------------------------------- the tree


@dataclass
class Layer:
    """Contexts of one length, and which symbols follow them how often.

    ``kept`` is the sum of a context's discounted counts. A context is the number of the context
    one shorter (its suffix) and the symbol before it; ``paths`` has both as one sorted key,
    ``entries`` context and next symbol as one sorted key.
    """

    paths: np.ndarray
    totals: np.ndarray
    kept: np.ndarray
    retained: np.ndarray
    entries: np.ndarray
    counts: np.ndarray


def _lookup(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The index of each wanted key among sorted keys, or -1."""
    if not len(keys):
        return np.full(len(wanted), -1, np.int64)
    if keys[-1] < max(4 * len(wanted), 1 << 16):
        # A table over all keys up to the last takes less time than a search for each.
        table = np.full(int(keys[-1]) + 2, -1, np.int64)
        table[keys] = np.arange(len(keys))
        return table[np.where((wanted < 0) | (wanted > keys[-1]), len(table) - 1, wanted)]
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


@dataclass
class SuffixTree:
    """Frequent words as symbols, one more for all others, and the contexts that make a difference."""

    symbols: dict[bytes, int]
    root: np.ndarray
    discount: float
    smoothing: float
    layers: list[Layer]

    @property
    def rare(self) -> int:
        return len(self.root) - 1

    def symbols_of(self, words: list[bytes]) -> np.ndarray:
        rare = self.rare
        return np.fromiter(map(self.symbols.get, words, itertools.repeat(rare)), np.int64, len(words))

    def paths(self, symbols: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
        """For each length of context the number of the one before each position, or -1.

        Before the first word of a text stands an end, and nothing stands before that.
        """
        starts = np.cumsum(sizes) - sizes
        place = np.arange(len(symbols)) - np.repeat(starts, sizes)
        context = np.zeros(len(symbols), np.int64)
        end = self.symbols.get(END, self.rare)
        for depth, layer in enumerate(self.layers, start=1):
            before = np.full(len(symbols), end, np.int64)
            before[depth:] = symbols[:-depth] if len(symbols) > depth else symbols[:0]
            before = np.where(place >= depth, before, end)
            known = (context >= 0) & (place >= depth - 1)
            key = np.where(known, context * len(self.root) + before, -1)
            context = _lookup(layer.paths, key)
            yield context

    def walk(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each symbol's probability in the state of the longest retained suffix, and the longest context."""
        p, context = self.root[symbols], np.full(len(symbols), -1, np.int64)
        for layer, context in zip(self.layers, self.paths(symbols, sizes), strict=True):
            p = np.where(context >= 0, self._within(layer, np.maximum(context, 0), symbols, p), p)
        return p, context

    def probabilities(self, symbols: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return self.walk(symbols, sizes)[0]

    def _within(self, layer: Layer, context, symbols, shorter) -> np.ndarray:
        """Discounted counts of the kept next symbols; what is left goes by the shorter context."""
        if not len(layer.totals):
            return shorter
        entry = _lookup(layer.entries, context * len(self.root) + symbols)
        counts = np.append(layer.counts - self.discount, 0.0)  # the last is for no entry, -1
        total = layer.totals[context] + self.smoothing
        p = (counts[entry] + (total - layer.kept[context]) * shorter) / total
        return np.where(layer.retained[context], p, shorter)


def _following(blocks: DataFrame, tree: SuffixTree, paths: np.ndarray) -> DataFrame:
    """How often each symbol follows each context of one more length, in training texts.

    ``paths`` are the candidate contexts, bounded in number; each task sums its blocks first.
    """
    sent = SparkSession.getActiveSession().sparkContext.broadcast((tree, paths))

    def count(batches):
        tree, paths = sent.value
        none = Layer(paths, *(np.zeros(0) for _ in range(5)))
        seeking = SuffixTree(tree.symbols, tree.root, tree.discount, tree.smoothing, [*tree.layers, none])
        width = len(tree.root)
        for batch in batches:
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            for row in range(batch.num_rows):
                block = _Tokens.read(columns, row)
                learn = np.repeat(block.trains, block.sizes)
                words = far.unpacked_words(columns["words"][row].as_py())
                symbols = seeking.symbols_of(words)[block.tokens]
                *_, context = seeking.paths(symbols, block.sizes)
                use = learn & (context >= 0)
                keys, n = np.unique(context[use] * width + symbols[use], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(n, pa.int64())], ["key", "n"]
                )

    read = blocks.select("sizes", "trains", "tokens", "words")
    return read.mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def _columns(df: DataFrame, *names: str) -> list[np.ndarray]:
    table = df.select(*names).toArrow()
    return [table.column(name).to_numpy() for name in names]


def _grow(
    blocks: DataFrame, tree: SuffixTree, paths: np.ndarray, least: int, divergence: float
) -> Layer:
    """A layer of contexts with their distributions, and which of them the test retains.

    A context is retained if its distribution diverges from that of its suffix by at least
    ``divergence`` nats. Next symbols seen fewer than ``least`` times share what is left.
    """
    width = len(tree.root)
    followed = stored(_following(blocks, tree, paths), "lm-contexts", free=True)
    context = F.floor(F.col("key") / F.lit(width)).cast("long")
    sums = followed.groupBy(context.alias("context")).agg(F.sum("n").alias("n"))
    at, n = _columns(sums, "context", "n")  # one row for each candidate
    totals = np.zeros(len(paths))
    totals[at] = n
    entries, counts = _columns(followed.filter(F.col("n") >= least), "key", "n")
    order = np.argsort(entries)
    entries, counts = entries[order], counts[order].astype(np.float64)
    of, symbol = entries // width, entries % width
    kept = np.bincount(of, counts - tree.discount, minlength=len(paths))
    layer = Layer(paths, totals, kept, np.ones(len(paths), bool), entries, counts)
    shorter = _suffix_probability(tree, paths, of, symbol)
    own = counts / np.maximum(totals[of], 1)
    gain = np.bincount(of, own * np.log(own / np.maximum(shorter, 1e-300)), minlength=len(paths))
    rest = np.maximum(1 - np.bincount(of, own, minlength=len(paths)), 0)
    rest_shorter = np.maximum(1 - np.bincount(of, shorter, minlength=len(paths)), 1e-12)
    gain += np.where(rest > 0, rest * np.log(np.maximum(rest, 1e-300) / rest_shorter), 0)
    layer.retained = gain >= divergence
    return layer


def _suffix_probability(tree: SuffixTree, paths, context, symbol) -> np.ndarray:
    """The symbols' probabilities after the contexts' suffixes, by the layers grown so far."""
    p = tree.root[symbol]
    width = len(tree.root)
    chain, at = [], paths[context] // width
    for layer in reversed(tree.layers):
        chain.append(at)
        at = layer.paths[at] // width if len(layer.paths) else at
    for layer, at in zip(tree.layers, reversed(chain), strict=True):
        p = tree._within(layer, at, symbol, p)
    return p


def _longer(tree: SuffixTree, least: int) -> np.ndarray:
    """Candidates one longer: a context and what followed it, seen at least ``least`` times.

    A string is a context and its next symbol; its own suffix must be a context too.
    """
    width, last = len(tree.root), tree.layers[-1]
    frequent = last.entries[last.counts >= least]
    strings = _strings(tree, frequent // width)
    strings = np.column_stack([strings, frequent % width])
    suffix = np.zeros(len(strings), np.int64)
    for depth, layer in enumerate(tree.layers, start=1):
        suffix = np.where(suffix >= 0, _lookup(layer.paths, suffix * width + strings[:, -depth]), -1)
    has = suffix >= 0
    return np.sort(suffix[has] * width + strings[has, 0])


def _strings(tree: SuffixTree, context: np.ndarray) -> np.ndarray:
    """The symbols of contexts of the last layer, the first one first."""
    width, columns = len(tree.root), []
    for layer in reversed(tree.layers):
        key = layer.paths[context]
        columns.append(key % width)
        context = key // width
    return np.column_stack(columns)


# ---------------------------------------------------------------------------- longer contexts


@dataclass
class _Reach:
    """The words of texts that longer contexts may have, and the places where these may tell more.

    ``hashes`` has one for each word of the block, zero for words that occur fewer than twice in
    training texts. ``p`` and ``codes`` are the probabilities that shorter contexts give to the places
    ``at``, the second one coded for the test, with rare words at the most that they can have.
    ``room`` is how many words before a place its contexts may have; they stand there without a gap.
    """

    tokens: np.ndarray
    hashes: np.ndarray
    sizes: np.ndarray
    rows: np.ndarray
    trains: np.ndarray
    at: np.ndarray
    p: np.ndarray
    codes: np.ndarray
    room: np.ndarray

    KINDS = (np.int32, np.uint64, np.int32, np.int32, bool, np.int32, np.float64, np.uint8, np.int32)

    def packed(self) -> bytes:
        # Probabilities are carried with 36 binary digits, as each byte counts for the size of what is written.
        p = ((self.p.view(np.uint64) + np.uint64(1 << 15)) & ~np.uint64((1 << 16) - 1)).view(np.float64)
        values = (self.tokens, self.hashes, self.sizes, self.rows, self.trains, self.at, p, self.codes, self.room)
        return far.packed(*(v.astype(k, copy=False) for v, k in zip(values, self.KINDS, strict=True)))

    @classmethod
    def unpacked(cls, value: bytes) -> _Reach:
        reach = cls(*far.unpacked(value, *cls.KINDS))
        reach.at = reach.at.astype(np.int64)
        return reach

    def asking(self, length: int, shards: int) -> far.Questions:
        """Questions about the places' contexts of ``length`` words, all of them in the text."""
        hashes = self.hashes[self.tokens]
        contexts = far.contexts_before(hashes, self.at, length)
        learn = np.repeat(self.trains, self.sizes)[self.at]
        return far.Questions.about(contexts, hashes[self.at], learn, self.codes, shards)

    def told(self, of, answers, discount: float, smoothing: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probabilities and codes by the longer contexts that are retained, and the answers' flags."""
        n, total, other, words, flags = (a[of] for a in answers)
        own, left = np.where(n > 0, n - discount, 0.0), other + discount * words + smoothing

        def mixed(p):
            return np.where(total > 0, (own + left * p) / (total + smoothing), p)

        return mixed(self.p), far.coded(mixed(far.decoded(self.codes))), flags

    def kept(self, go: np.ndarray, once: np.ndarray, asked: int, length: int) -> _Reach | None:
        """What is left to ask about contexts of ``length`` words, at the places that ``go`` on.

        Nothing is kept after a context that is not seen twice, nor after any that has a string which is
        not. Such strings are the words of hash zero, and the ``asked`` words before each of the places
        ``once`` with the word there. Words that no context can have any more are left out.
        """
        n = len(self.tokens)
        last = np.full(n + 1, -1)  # the last start of such a string that ends before a place
        last[once + 1] = once - asked
        unseen = np.flatnonzero(self.hashes[self.tokens] == 0)
        last[unseen + 1] = unseen
        np.maximum.accumulate(last, out=last)
        room = np.minimum(self.room, self.at - 1 - last[self.at])
        go = go & (room >= length)
        at, room = self.at[go], room[go]
        if not len(at):
            return None
        within = np.bincount(at - room, minlength=n + 1) - np.bincount(at + 1, minlength=n + 1)
        stay = np.cumsum(within)[:n] > 0
        sizes = np.bincount(np.repeat(np.arange(len(self.sizes)), self.sizes)[stay], minlength=len(self.sizes))
        has = sizes > 0
        at = (np.cumsum(stay) - 1)[at]
        used, tokens = np.unique(self.tokens[stay], return_inverse=True)
        return _Reach(
            tokens, self.hashes[used], sizes[has], self.rows[has], self.trains[has], at, self.p[go], self.codes[go], room
        )


@dataclass
class _Scale:
    """What scoring needs to know of the whole corpus."""

    tree: SuffixTree
    total: int
    denominator: float
    least: int

    @property
    def length(self) -> int:
        """Words in the shortest contexts below the top; the top's probabilities depend on no more."""
        return max(2, len(self.tree.layers))

    def begin(self, block: _Tokens, words: list[bytes]) -> tuple[np.ndarray, _Reach, np.ndarray]:
        """The tree's probability of each token's symbol, the places below it, and those it holds.

        A context of frequent words that the top tree has is left to it, so that no shard is asked
        about the next words of a very common one; what is longer is asked about.
        """
        symbols = self.tree.symbols_of(words)
        most = min(1.0, (self.least - 0.9) / self.denominator / self.tree.root[self.tree.rare])
        p = np.empty(len(block.tokens))
        codes = np.empty(len(block.tokens), np.uint8)
        held = np.zeros(len(block.tokens), bool)
        starts = np.cumsum(block.sizes) - block.sizes
        low = 0
        # Bounded memory: the walk is done over a limited number of tokens at a time.
        while low < len(block.sizes):
            high = max(int(np.searchsorted(starts, starts[low] + 250_000)), low + 1)
            span = slice(starts[low], starts[high] if high < len(starts) else len(block.tokens))
            own, sizes = symbols[block.tokens[span]], block.sizes[low:high]
            p[span], context = self.tree.walk(own, sizes)
            codes[span] = far.coded(p[span] * np.where(own == self.tree.rare, most, 1.0))
            if len(self.tree.layers) == self.length:
                pooled = np.append(0, np.cumsum(own == self.tree.rare))
                at = np.arange(len(own))
                held[span] = (context >= 0) & (pooled[at] == pooled[np.maximum(at - self.length, 0)])
            low = high
        places = block.places
        at = np.flatnonzero(places >= self.length)
        rows = np.arange(len(block.sizes), dtype=np.int32)
        hashes = far.word_hashes(words)
        reach = _Reach(block.tokens, hashes, block.sizes, rows, block.trains, at, p[at], codes[at], places[at])
        return p, reach, held[at]


def _sum_by(of: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(of, values, minlength=n)


# ---------------------------------------------------------------------------- scoring


def score_texts(
    docs: DataFrame,
    train: Column,
    *,
    ident: str = "doc_id",
    text: str = "text",
    symbol_share: float = 1e-4,
    entry_share: float = 1e-6,
    depth: int = 2,
    divergence: float = 0.05,
    discount: float = 0.75,
    smoothing: float = 300.0,
    least: int = 2,
    long_smoothing: float = 1.0,
    stretch: int = 3,
    block_bytes: int = 8_000_000,
    shard_tokens: int = 1_000_000,
) -> DataFrame:
    """Scores every text: its id, ``n_tokens, n_known, train_tokens, base_score, score``.

    Texts for which ``train`` holds teach; all are scored. Tokens are words (runs of anything but
    ASCII white space, A to Z in lower case) and one end. The base is the sum of
    log10((c + 0.1) / (N + 0.1 (V + 1))) over the tokens.

    The top of the tree has contexts of up to ``depth`` symbols: the words with at least ``symbol_share``
    of all training tokens, the end among them if so, and one for all other words, which divides
    among them as the base does. A context is a candidate there if it has that share too, and next
    symbols are kept apart from ``entry_share`` on. The shares bound what is sent to tasks: at most
    1 / symbol_share contexts of each length and 1 / entry_share counts.

    Below the top stand contexts of whole words, which grow with the corpus: of max(2, depth) words
    first, then of ``stretch`` times as many, and so on. Next words seen ``least`` times are kept, however
    large the corpus is. A longer context is asked about where the shorter one keeps some next word but
    not always the same, or is one of frequent words that the top holds; so lengths end by what the
    corpus has. Before a context stand as many words of the text itself. Its counts are never sent to
    all: they are made in shards of about ``shard_tokens`` tokens and go to the blocks that asked.

    A context is retained if its distribution diverges from that of its suffix by ``divergence`` nats,
    and texts are scored in the state of the longest retained suffix. ``discount`` (below 2) is taken
    from each kept count; it, what is not kept, and ``smoothing`` (below the top ``long_smoothing``) further
    counts are given to the shorter context, so every distribution sums to one. Below the top the test
    takes a rare word's shorter probability at the most that it can be, in steps of an eighth of a nat,
    so that a divergence it finds is not an effect of the pool of rare words.

    Null and empty texts are one end. Repeated rows, and rows without an id, are scored each. If
    nothing teaches, N and V are 0 and both scores fall back to the base's formula. An empty table
    gives an empty result.
    """
    blocks, buckets = blocks_of(docs, ident, text, train, block_bytes)
    total, listed, tokens = blocks.agg(
        F.coalesce(F.sum("learned"), F.lit(0)),
        F.coalesce(F.sum("n_words"), F.lit(0)),
        F.coalesce(F.sum("n_tokens"), F.lit(0)),
    ).first()
    top_least = max(2, int(np.ceil(total * symbol_share)))
    word_shards = 1 + listed // shard_tokens
    known = stored(far.word_counts(blocks, word_shards, top_least), "lm-words", compression="zstd", free=True)
    words, counts, vocabulary = _frequent(known)
    denominator = total + 0.1 * (vocabulary + 1)
    p = (counts + 0.1) / denominator
    root = np.append(p, max(1 - p.sum(), 0.1 / denominator))
    tree = SuffixTree({w: i for i, w in enumerate(words)}, root, discount, smoothing, [])
    paths = np.arange(len(root), dtype=np.int64)
    entry_least = max(2, int(np.ceil(total * entry_share)))
    for _ in range(depth if total else 0):
        tree.layers.append(_grow(blocks, tree, paths, entry_least, divergence))
        paths = _longer(tree, top_least)
        if not len(paths):
            break
    scale = _Scale(tree, total, denominator, top_least)
    growth = _Growth(least, divergence, discount, long_smoothing, stretch, shard_tokens)
    return _scored(blocks, known, (word_shards, 1 + tokens // shard_tokens, buckets), scale, growth, ident)


@dataclass
class _Growth:
    """How contexts of whole words grow."""

    least: int
    divergence: float
    discount: float
    smoothing: float
    stretch: int
    shard_tokens: int
    bucket_places: int = 500_000


def _frequent(known: DataFrame) -> tuple[list[bytes], np.ndarray, int]:
    """The frequent words and their counts, bounded by their share, and the number of all words."""
    vocabulary = known.agg(F.coalesce(F.sum("vocabulary"), F.lit(0))).first()[0]
    rows = known.filter("word IS NOT NULL").select("word", "c").collect()
    rows.sort(key=lambda r: (-r.c, bytes(r.word)))
    return [bytes(r.word) for r in rows], np.array([r.c for r in rows], np.float64), vocabulary


_REACH = [T.StructField("reach", T.BinaryType()), T.StructField("places", T.LongType())]


def _scored(blocks, known, numbers, scale: _Scale, growth: _Growth, ident) -> DataFrame:
    sent = blocks.sparkSession.sparkContext.broadcast(scale)
    word_shards, shards, buckets = numbers
    length = scale.length

    def ask(batches):
        for batch in batches:
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            for row in range(batch.num_rows):
                block = _Tokens.read(columns, row)
                _, reach, held = sent.value.begin(block, far.unpacked_words(columns["words"][row].as_py()))
                yield _without(reach, held).asking(length, shards).messages(columns["block"][row].as_py())

    def score(block: pa.Table, answers: pa.Table) -> pa.Table:
        scale = sent.value
        columns = {name: block.column(name).combine_chunks() for name in block.column_names}
        held = _Tokens.read(columns, 0)
        words = far.unpacked_words(columns["words"][0].as_py())
        far_away = pc.field("kind") == 1
        c = far.counts_told(answers.filter(~far_away), words, word_shards)
        base = np.log10((c + 0.1) / scale.denominator)
        p, reach, top = scale.begin(held, words)
        rare = scale.tree.symbols_of(words) == scale.tree.rare
        p *= np.where(rare, 10.0 ** (base - np.log10(scale.tree.root[scale.tree.rare])), 1.0)[held.tokens]
        reach.p = p[reach.at]
        asked = _without(reach, top)
        of = asked.asking(length, shards).of
        new, codes, flags = asked.told(of, far.told_to(answers.filter(far_away)), growth.discount, growth.smoothing)
        p[asked.at] = new
        reach.p[~top], reach.codes[~top] = new, codes
        go = top.copy()
        go[~top] = flags & far.LONGER > 0
        reach.hashes = np.where(c >= 2, reach.hashes, np.uint64(0))
        further = reach.kept(go, asked.at[flags & far.AGAIN == 0], length, length * growth.stretch)
        n = len(held.sizes)
        text = np.repeat(np.arange(n), held.sizes)
        sums = [
            held.sizes.astype(np.int64),
            _sum_by(text, (c > 0)[held.tokens], n).astype(np.int64),
            _sum_by(text, base[held.tokens], n),
            _sum_by(text, np.log10(p), n),
        ]
        return pa.Table.from_arrays(
            [columns["block"], columns["ids"], *(pa.array([v]) for v in sums), *_further(further)], schema.names
        )

    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("ids", blocks.schema["ids"].dataType),
            T.StructField("n_tokens", T.ArrayType(T.LongType())),
            T.StructField("n_known", T.ArrayType(T.LongType())),
            T.StructField("base_score", T.ArrayType(T.DoubleType())),
            T.StructField("score", T.ArrayType(T.DoubleType())),
            *_REACH,
        ]
    )
    rows = blocks.select("block", "ids", "sizes", "trains", "tokens", "words")
    told = far.answers_of(
        rows.mapInArrow(ask, far.ASKED), growth.least, growth.divergence
    ).withColumn("kind", F.lit(1))
    told = told.unionByName(
        known.filter("told IS NOT NULL").select("block", "shard", "told", F.lit(0).alias("kind"))
    )
    scored = rows.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(score, schema)
    first = _bucketed(scored, "lm-scores", buckets)
    changes = _lengthened(first, length * growth.stretch, growth, buckets)
    each = F.arrays_zip("ids", "n_tokens", "n_known", "base_score", "score")
    texts = first.select("block", F.posexplode(each).alias("row", "each")).select(
        "block",
        "row",
        F.col("each.ids").alias("id"),
        *(F.col(f"each.{name}") for name in ("n_tokens", "n_known", "base_score", "score")),
    )
    score_now = F.col("score")
    if changes:
        union = changes[0]
        for more in changes[1:]:
            union = union.unionByName(more)
        change = union.groupBy("block", "row").agg(F.sum("change").alias("change"))
        texts = texts.join(change, ["block", "row"], "left")
        score_now = F.col("score") + F.coalesce("change", F.lit(0.0))
    return texts.select(
        F.col("id").alias(ident),
        "n_tokens",
        "n_known",
        F.lit(scale.total).cast("long").alias("train_tokens"),
        "base_score",
        score_now.alias("score"),
    )


def _without(reach: _Reach, held: np.ndarray) -> _Reach:
    return _Reach(
        reach.tokens, reach.hashes, reach.sizes, reach.rows, reach.trains,
        reach.at[~held], reach.p[~held], reach.codes[~held], reach.room[~held],
    )


def _further(reach: _Reach | None) -> list[pa.Array]:
    if reach is None:
        return [pa.array([None], pa.binary()), pa.array([0], pa.int64())]
    return [pa.array([reach.packed()], pa.binary()), pa.array([len(reach.at)], pa.int64())]


def _lengthened(first: DataFrame, length: int, growth: _Growth, buckets: int) -> list[DataFrame]:
    """Lets contexts grow until no place is left; what each length changes in the texts' scores.

    Fewer places are written in fewer buckets, as a task takes time of its own.
    """
    changes, now = [], first
    cores = first.sparkSession.sparkContext.defaultParallelism
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("rows", T.ArrayType(T.IntegerType())),
            T.StructField("changes", T.ArrayType(T.DoubleType())),
            *_REACH,
        ]
    )
    while True:
        now = now.filter("reach IS NOT NULL").select("block", "reach", "places")
        places = now.agg(F.coalesce(F.sum("places"), F.lit(0))).first()[0]
        if not places:
            return changes
        buckets = min(buckets, max(cores, 1 + places // growth.bucket_places))
        now = _bucketed(_one_longer(now, length, 1 + places // growth.shard_tokens, growth, schema), "lm-longer", buckets)
        changes.append(now.select("block", F.inline(F.arrays_zip("rows", "changes")).alias("row", "change")))
        length *= growth.stretch


def _one_longer(now: DataFrame, length: int, shards: int, growth: _Growth, schema) -> DataFrame:
    def ask(batches):
        for batch in batches:
            for block, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield _Reach.unpacked(value).asking(length, shards).messages(block)

    def change(block: pa.Table, answers: pa.Table) -> pa.Table:
        reach = _Reach.unpacked(block.column("reach")[0].as_py())
        of = reach.asking(length, shards).of
        p, codes, flags = reach.told(of, far.told_to(answers), growth.discount, growth.smoothing)
        n = len(reach.sizes)
        text = np.repeat(np.arange(n), reach.sizes)[reach.at]
        changed = _sum_by(text, np.log10(p / reach.p), n)
        rows = reach.rows
        reach.p, reach.codes = p, codes
        once = reach.at[flags & far.AGAIN == 0]
        further = reach.kept(flags & far.LONGER > 0, once, length, length * growth.stretch)
        return pa.Table.from_arrays(
            [block.column("block").combine_chunks(), pa.array([rows]), pa.array([changed]), *_further(further)],
            schema.names,
        )

    state = now.select("block", "reach")
    told = far.answers_of(state.mapInArrow(ask, far.ASKED), growth.least, growth.divergence)
    return state.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(change, schema)
