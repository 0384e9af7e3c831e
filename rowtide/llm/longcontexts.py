"""Contexts of many words, counted across blocks: questions by shard, answers in the same order.

A block asks about each different string (a context and its next word) that it has, once and with
how often it occurs there. Questions are sorted by key, packed, and dealt to shards by a hash of the
context, so that a shard sees all next words of its contexts; what it answers is packed in the order
of the questions and needs no keys. Nothing is held whole: a shard has about as many questions as
its size says, and the number of shards follows the corpus.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame

# A key has so many bits of the context and of its next word. Two of a shard's contexts (about a million,
# by the default) are taken for one by a chance of 1 in 16,000, two next words of a context by 1 in a million,
# at every size of the corpus, as shards do not grow with it.
CONTEXT_BITS, NEXT_BITS = 34, 20
SHARD_BITS = 28  # of the context's hash, those that the key has not
CODES = 8.0  # steps of a coded probability in each nat
STEP = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2 ** 64
BACK = pow(STEP, -1, 1 << 64)
LONGER, AGAIN = 1, 2  # flags of an answer
# Made once for a worker, as making one takes longer than a message does.
_COMPRESSOR, _DECOMPRESSOR = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value, byte by byte; ``unpacked`` needs their types."""
    planes = (np.ascontiguousarray(a.view(np.uint8).reshape(a.size, -1).T) if a.size else a for a in arrays)
    parts = [np.array([a.size for a in arrays], np.int64).tobytes(), *(p.tobytes() for p in planes)]
    return _COMPRESSOR.compress(b"".join(parts))


def unpacked(value: bytes, *types) -> list[np.ndarray]:
    data = _DECOMPRESSOR.decompress(value)
    sizes = np.frombuffer(data, np.int64, len(types))
    arrays, at = [], sizes.nbytes
    for size, kind in zip(sizes.tolist(), map(np.dtype, types), strict=True):
        planes = np.frombuffer(data, np.uint8, size * kind.itemsize, at).reshape(kind.itemsize, size)
        arrays.append(np.ascontiguousarray(planes.T).view(kind).ravel())
        at += planes.nbytes
    return arrays


def packed_words(words: list[bytes]) -> bytes:
    """Words as one value; none has white space."""
    return packed(np.frombuffer(b"\n".join(words), np.uint8))


def unpacked_words(value: bytes) -> list[bytes]:
    return unpacked(value, np.uint8)[0].tobytes().split(b"\n")


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A hash of each word, with a next word's bits never all zero."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return hashes | np.uint64(1)


def coded(p: np.ndarray) -> np.ndarray:
    """Probabilities to an eighth of a nat, for the divergence test only."""
    return np.clip(np.rint(-CODES * np.log(np.maximum(p, 1e-300))), 0, 255).astype(np.uint8)


def decoded(code: np.ndarray) -> np.ndarray:
    return np.exp(-code.astype(np.float64) / CODES)


def contexts_before(hashes: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """A hash of the ``length`` words before each place ``at``, in a fixed number of steps."""
    # Arrays of a block's length are changed in place, as their number is what a task needs in memory.
    n = len(hashes)
    sums = np.zeros(n + 1, np.uint64)
    sums[1:] = STEP
    np.cumprod(sums[1:], out=sums[1:])
    sums[1:] *= hashes
    np.cumsum(sums[1:], out=sums[1:])
    before = at - length
    mixed = sums[at]
    mixed -= sums[before]
    del sums
    backs = np.cumprod(np.full(n, BACK, np.uint64))
    mixed *= backs[before]
    del backs, before
    for factor in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
        mixed ^= mixed >> np.uint64(33)
        mixed *= np.uint64(factor)
    mixed ^= mixed >> np.uint64(33)
    return mixed


@dataclass
class Questions:
    """A block's different strings by shard and key, and which of them each place is."""

    shards: np.ndarray
    keys: np.ndarray
    counts: np.ndarray
    codes: np.ndarray
    of: np.ndarray

    @classmethod
    def about(cls, contexts, nexts, learn, codes, shards: int) -> Questions:
        """``nexts`` of zero stand for words that cannot be kept; ``learn`` says which places teach."""
        small = np.uint16 if shards <= 1 << 16 else np.uint32
        shard = ((contexts >> np.uint64(64 - SHARD_BITS)) % np.uint64(shards)).astype(small)
        keys = contexts & np.uint64((1 << CONTEXT_BITS) - 1)
        keys <<= np.uint64(NEXT_BITS)
        keys |= nexts & np.uint64((1 << NEXT_BITS) - 1)
        order = np.argsort(keys).astype(np.int32)
        order = order[np.argsort(shard[order], kind="stable").astype(np.int32)]
        shard, keys = shard[order], keys[order]
        new = np.ones(len(keys), bool)
        new[1:] = (keys[1:] != keys[:-1]) | (shard[1:] != shard[:-1])
        shard, keys = shard[new], keys[new]
        entry = np.cumsum(new, dtype=np.int32) - 1
        of = np.empty(len(order), np.int32)
        of[order] = entry
        counts = np.bincount(of[learn], minlength=len(keys)).astype(np.uint32)
        return cls(shard, keys, counts, codes[order[new]], of)

    def messages(self, block: int) -> pa.RecordBatch:
        """One packed row for each shard; sorted keys go as differences."""
        numbers, starts = np.unique(self.shards, return_index=True)
        ends = np.append(starts, len(self.shards))[1:]
        values = []
        for low, high in zip(starts, ends, strict=True):
            steps = np.diff(self.keys[low:high], prepend=np.uint64(0))
            values.append(packed(steps, self.counts[low:high], self.codes[low:high]))
        return pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array([block] * len(numbers), pa.int64()), pa.array(values, pa.binary())],
            ["shard", "block", "asked"],
        )


ASKED = "shard int, block long, asked binary"
ANSWERED = "block long, shard int, told binary"


def answers_of(questions: DataFrame, least: int, divergence: float) -> DataFrame:
    """For each question the counts of its context, if the divergence test retains that.

    An answer has the string's count if it is kept (seen ``least`` times or more), the context's
    count, how much of it is not kept and how many next words are, all zero for a context that is
    not retained. Its flags say whether longer contexts may tell more (something is kept, and not all that
    follows is one word) and whether the string itself is kept, be its context retained or not.
    """

    def tell(asked: pa.Table) -> pa.Table:
        values = asked.column("asked").to_pylist()
        parts = [unpacked(v, np.uint64, np.uint32, np.uint8) for v in values]
        sizes = np.array([len(codes) for *_, codes in parts])
        keys = np.concatenate([np.cumsum(steps, dtype=np.uint64) for steps, *_ in parts])
        order = np.argsort(keys)
        ordered = keys[order]
        new = np.append(True, ordered[1:] != ordered[:-1])
        entry = np.cumsum(new) - 1
        starts = np.flatnonzero(new)
        n = np.add.reduceat(np.concatenate([c for _, c, _ in parts])[order].astype(np.int64), starts)
        q = decoded(np.minimum.reduceat(np.concatenate([c for *_, c in parts])[order], starts))
        distinct = ordered[new]
        context = distinct >> np.uint64(NEXT_BITS)
        context = np.cumsum(np.append(True, context[1:] != context[:-1])) - 1
        total = np.bincount(context, n).astype(np.int64)
        kept = (n >= least) & ((distinct & np.uint64((1 << NEXT_BITS) - 1)) != 0)
        seen = np.where(kept, n, 0)
        own = seen / np.maximum(total, 1)[context]
        gain = np.bincount(context, np.where(kept, own * np.log(np.where(kept, own, 1) / q), 0.0))
        rest = np.maximum(1 - np.bincount(context, own), 0)
        shorter = np.maximum(1 - np.bincount(context, np.where(kept, q, 0.0)), 1e-12)
        gain += np.where(rest > 1e-12, rest * np.log(np.maximum(rest, 1e-12) / shorter), 0)
        some = np.bincount(context, kept) > 0
        retained = some & (gain >= divergence)
        other = total - np.bincount(context, seen).astype(np.int64)
        words = np.bincount(context, kept).astype(np.int64)
        most = np.maximum.reduceat(seen, np.flatnonzero(np.diff(context, prepend=-1)))
        longer = np.where(some & (most < total), LONGER, 0).astype(np.uint8)
        again = np.where(kept, AGAIN, 0).astype(np.uint8)
        back = np.empty(len(keys), np.int64)
        back[order] = entry
        told, low = [], 0
        for size in sizes:
            at = back[low : low + size]
            c = context[at]
            holds = retained[c]
            values = (np.where(holds, x, 0) for x in (seen[at], total[c], other[c], words[c]))
            told.append(packed(*values, longer[c] | again[at]))
            low += size
        return pa.Table.from_arrays(
            [asked.column("block"), asked.column("shard"), pa.array(told, pa.binary())], ["block", "shard", "told"]
        )

    return questions.groupBy("shard").applyInArrow(tell, ANSWERED)


def told_to(answers: pa.Table) -> list[np.ndarray]:
    """A block's answers, in the order of its questions."""
    types = (np.int64, np.int64, np.int64, np.int64, np.uint8)
    rows = sorted(zip(answers.column("shard").to_pylist(), answers.column("told").to_pylist(), strict=True))
    parts = [unpacked(v, *types) for _, v in rows]
    return [np.concatenate(a) for a in zip(*parts, strict=True)] if parts else [np.zeros(0, t) for t in types]


# ---------------------------------------------------------------------------- words


def words_asked(words: list[bytes], shards: int) -> list[np.ndarray]:
    """For each shard the places of its words, in order of the words."""
    shard = (word_hashes(words) >> np.uint64(32)) % np.uint64(shards)
    order = np.argsort(shard, kind="stable")
    ends = np.searchsorted(shard[order], np.arange(1, shards + 1, dtype=np.uint64), side="left")
    return np.split(order, ends[:-1])


COUNTED = "block long, shard int, told binary, word binary, c long, vocabulary long"


def word_counts(blocks: DataFrame, shards: int, least: int) -> DataFrame:
    """The count of every word in all training texts, told to the blocks that have it.

    A row tells a block the counts of its words of one shard. Beside these rows, frequent words stand with
    their counts, and each shard's number of words that training texts have.
    """

    def ask(batches):
        for batch in batches:
            columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            for row in range(batch.num_rows):
                words = unpacked_words(columns["words"][row].as_py())
                (counts,) = unpacked(columns["counts"][row].as_py(), np.int64)
                numbers, values = [], []
                for shard, at in enumerate(words_asked(words, shards)):
                    if len(at):
                        named = np.frombuffer(b"\n".join(words[i] for i in at), np.uint8)
                        numbers.append(shard)
                        values.append(packed(named, counts[at]))
                block = columns["block"][row].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers, pa.int32()), pa.array([block] * len(numbers), pa.int64()), pa.array(values, pa.binary())],
                    ["shard", "block", "asked"],
                )

    def tell(asked: pa.Table) -> pa.Table:
        parts = [unpacked(v, np.uint8, np.int64) for v in asked.column("asked").to_pylist()]
        words = pa.chunked_array([pa.array(named.tobytes().split(b"\n"), pa.binary()) for named, _ in parts])
        encoded = words.combine_chunks().dictionary_encode()
        at = encoded.indices.to_numpy()
        total = np.zeros(len(encoded.dictionary), np.int64)
        np.add.at(total, at, np.concatenate([n for _, n in parts]))
        ends = np.cumsum([len(n) for _, n in parts])[:-1]
        told = [packed(total[a]) for a in np.split(at, ends)]
        often = np.flatnonzero(total >= least)
        rows, more = len(told), len(often) + 1
        return pa.Table.from_arrays(
            [
                pa.array([*asked.column("block").to_pylist(), *[None] * more], pa.int64()),
                pa.array([*asked.column("shard").to_pylist(), *[None] * more], pa.int32()),
                pa.array([*told, *[None] * more], pa.binary()),
                pa.array([*[None] * rows, *encoded.dictionary.take(pa.array(often)).to_pylist(), None], pa.binary()),
                pa.array([*[None] * rows, *total[often].tolist(), None], pa.int64()),
                pa.array([*[None] * (rows + more - 1), int((total > 0).sum())], pa.int64()),
            ],
            ["block", "shard", "told", "word", "c", "vocabulary"],
        )

    asked = blocks.select("block", "words", "counts").mapInArrow(ask, ASKED)
    return asked.groupBy("shard").applyInArrow(tell, COUNTED)


def counts_told(answers: pa.Table, words: list[bytes], shards: int) -> np.ndarray:
    """The counts of a block's words, from the rows of its shards."""
    c = np.zeros(len(words), np.int64)
    places = words_asked(words, shards)
    for shard, told in zip(answers.column("shard").to_pylist(), answers.column("told").to_pylist(), strict=True):
        c[places[shard]] = unpacked(told, np.int64)[0]
    return c
