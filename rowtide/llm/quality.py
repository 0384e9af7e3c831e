"""Quality classifier: neighbours among labelled latent-semantic vectors vote."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import flat_bytes, pieces

# A text's terms fall into this many slots: shapes of three bytes, letters of three bytes, words
# that repeat one shortly before, and words.
SHAPES, LETTERS, REPEATS, WORDS = 1024, 2048, 8, 1016
SLOTS = SHAPES + LETTERS + REPEATS + WORDS
# Counting terms takes about 66 bytes of memory a byte of a block, in every Python worker of an executor.
_BLOCK_BYTES = 250_000
_BLOCK_ROWS = 128
_GOLDEN = np.uint32(2654435761)


def _byte_classes() -> np.ndarray:
    """Upper case, lower case, digits, blanks, line ends; each other printable sign by itself."""
    classes = np.ones(256, np.uint8)
    classes[:32] = 0
    classes[[9, 11, 12, 32]] = 4
    classes[[10, 13]] = 5
    signs = [c for c in range(33, 127) if not chr(c).isalnum()]
    classes[signs] = np.arange(6, 6 + len(signs))
    classes[ord("A") : ord("Z") + 1] = 2
    classes[ord("0") : ord("9") + 1] = 3
    return classes


_CLASSES = _byte_classes()
_FOLDED = np.frombuffer(bytes(range(256)).lower(), np.uint8)
_BYTE_CODES = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (
    np.arange(1, 257, dtype=np.uint64) << np.uint64(33)
)


def _spread(values: np.ndarray, bits: int) -> np.ndarray:
    return ((values * _GOLDEN) >> np.uint32(32 - bits)).astype(np.int32)


def _word_codes(flat: np.ndarray, blank: np.ndarray, begins: np.ndarray):
    """A code for each word, and the index of its first byte."""
    letter = ~blank
    fresh = letter.copy()
    fresh[1:] &= blank[:-1] | begins[1:]
    first = np.flatnonzero(fresh)
    if not len(first):
        return np.zeros(0, np.uint64), first
    at = np.arange(len(flat), dtype=np.uint64)
    reach = np.diff(np.concatenate([[0], first[1:], [len(flat)]]))
    place = at - np.repeat(first.astype(np.uint64), reach)
    mixed = _BYTE_CODES[flat] * (place * np.uint64(2) + np.uint64(1))
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed[blank] = 0
    return np.add.reduceat(mixed, first), first


def term_counts(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Counts of terms by slot, a row for each text."""
    rows = len(starts) - 1
    if not len(flat):
        return np.zeros((rows, SLOTS), np.float32)
    row = np.repeat(np.arange(rows, dtype=np.int32), np.diff(starts))
    base = row * np.int32(SLOTS)
    begins = np.ones(len(flat), bool)
    begins[1:] = row[1:] != row[:-1]
    classes, folded = _CLASSES[flat], _FOLDED[flat].astype(np.uint32)
    wide = classes.astype(np.uint32)
    inside = row[:-2] == row[2:]
    keys = []
    for values, low, bits in ((wide, 0, 10), (folded, SHAPES, 11)):
        code = ((values[:-2] << 16) | (values[1:-1] << 8) | values[2:])[inside]
        keys.append(base[:-2][inside] + _spread(code, bits) + np.int32(low))
    blank = (classes == 4) | (classes == 5)
    with np.errstate(over="ignore"):
        words, first = _word_codes(flat, blank, begins)
    word_row = row[first]
    low = SHAPES + LETTERS
    for lag in (1, 2):
        same = (words[lag:] == words[:-lag]) & (word_row[lag:] == word_row[:-lag])
        keys.append(word_row[lag:][same] * np.int32(SLOTS) + np.int32(low + lag))
    slot = (words % np.uint64(WORDS)).astype(np.int32) + np.int32(low + REPEATS)
    keys.append(word_row * np.int32(SLOTS) + slot)
    counts = np.bincount(np.concatenate(keys), minlength=rows * SLOTS)
    return counts.astype(np.float32).reshape(rows, SLOTS)


def _blocks(array: pa.Array) -> Iterator[np.ndarray]:
    """Term counts of a column of texts, a bounded number of rows and bytes at a time."""
    flat, starts = flat_bytes(array)
    for first, last in pieces(starts, _BLOCK_BYTES):
        for low in range(first, last, _BLOCK_ROWS):
            high = min(last, low + _BLOCK_ROWS)
            own = starts[low : high + 1]
            yield term_counts(flat[own[0] : own[-1]], own - own[0])


def document_frequency(docs: DataFrame, text: str) -> tuple[int, np.ndarray]:
    """How many of all texts there are, and how many have a term in each slot.

    Each task sends one row of fixed length, summed by slot before it comes to the driver.
    """

    def count(batches):
        total, have = 0, np.zeros(SLOTS, np.int64)
        for batch in batches:
            for counts in _blocks(batch.column(0)):
                total += len(counts)
                have += (counts > 0).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(SLOTS + 1), pa.int32()), pa.array([*have.tolist(), total], pa.int64())],
            ["slot", "n"],
        )

    parts = docs.select(F.col(text).cast("binary")).mapInArrow(count, "slot int, n long")
    sums = dict(parts.groupBy("slot").agg(F.sum("n")).collect())
    have = np.array([sums.get(i) or 0 for i in range(SLOTS)], np.float64)
    return sums.get(SLOTS) or 0, have


def labelled_sample(
    docs: DataFrame, labels: DataFrame, ident: str, text: str, label: str, per_label: int
) -> tuple[list[bytes], np.ndarray]:
    """At most ``per_label`` texts of each label, chosen by a hash of the id.

    An id with two different labels teaches neither, nor does a null label.
    """
    known = (
        labels.select(F.col(ident).alias("id"), F.col(label).cast("int").alias("label"))
        .filter(F.col("id").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .filter("label = other")
        .select("id", "label", F.xxhash64("id").alias("order"))
    )
    chosen = known.filter("label = 0").orderBy("order").limit(per_label).unionByName(
        known.filter("label = 1").orderBy("order").limit(per_label)
    )
    # Bounded by 2 x per_label rows, whatever the size of the tables.
    found = (
        docs.select(F.col(ident).alias("id"), F.col(text).cast("binary").alias("text"))
        .join(F.broadcast(chosen), "id")
        .groupBy("id", "label", "order")
        .agg(F.min("text").alias("text"))
        .orderBy("order")
        .select("label", "text")
        .collect()
    )
    return [bytes(r.text or b"") for r in found], np.array([r.label for r in found], np.float32)


@dataclass(frozen=True)
class QualityModel:
    """Latent axes over weighted terms, the labelled vectors on them, and their labels."""

    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int
    sharpness: float

    def _place(self, counts: np.ndarray) -> np.ndarray:
        vectors = (np.log1p(counts) * self.weights) @ self.axes
        return _unit(vectors)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Shares of label 1 among the nearest labelled vectors, weighted by cosine.

        The cosines to all labelled vectors are exact. Equal cosines at the edge all vote.
        A text without terms, or like no labelled one, gets the even score 0.5.
        """
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        cosine = np.maximum(self._place(counts) @ self.vectors.T, 0).astype(np.float64)
        k = min(self.neighbours, cosine.shape[1])
        edge = np.partition(cosine, cosine.shape[1] - k, axis=1)[:, [cosine.shape[1] - k]]
        votes = np.where(cosine >= edge, cosine**self.sharpness, 0)
        total = votes.sum(axis=1)
        score = np.divide(votes @ self.labels, total, out=np.full(len(total), 0.5), where=total > 0)
        # Rounded, so that equal texts in different blocks get equal scores.
        return np.clip(np.round(score, 6), 0, 1)

    def column(self, text: Column) -> Column:
        """The score of a text column. The model is of bounded size and goes to every task."""
        from pyspark.sql import SparkSession

        sent = SparkSession.getActiveSession().sparkContext.broadcast(self)

        @F.arrow_udf("double")
        def quality(texts: pa.Array) -> pa.Array:
            model = sent.value
            scores = [model.score(counts) for counts in _blocks(texts)]
            return pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())

        return quality(text.cast("binary"))


def _unit(vectors: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.divide(vectors, norm, out=np.zeros_like(vectors), where=norm > 0)


def latent_axes(vectors: np.ndarray, rank: int, seed: int) -> np.ndarray:
    """Leading right singular vectors, by randomised subspace iteration on the Gram matrix."""
    rank = min(rank, *vectors.shape)
    gram = vectors.T @ vectors
    basis = np.random.default_rng(seed).standard_normal((gram.shape[0], rank + 16))
    for _ in range(5):
        basis = np.linalg.qr(gram @ basis)[0]
    _, small = np.linalg.eigh(basis.T @ gram @ basis)
    return (basis @ small[:, ::-1][:, :rank]).astype(np.float32)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    ident: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    per_label: int = 1024,
    rank: int = 48,
    neighbours: int = 15,
    sharpness: float = 8.0,
    seed: int = 0,
) -> QualityModel:
    """Learns the classifier.

    Term weights come from all of ``docs``. The latent axes and the voting vectors come from at
    most ``per_label`` labelled texts for each of the two labels, which is the documented bound of
    the sample and of the broadcast (2 x per_label x rank numbers). ``labels`` decides which rows
    may teach; the caller leaves out those held back. Without labelled rows every score is 0.5.
    """
    total, have = document_frequency(docs, text)
    weights = (np.log((1 + total) / (1 + have)) + 0.1).astype(np.float32)
    texts, marks = labelled_sample(docs, labels, ident, text, label, per_label)
    if not texts:
        none = np.zeros((0, 1), np.float32)
        return QualityModel(weights, np.zeros((SLOTS, 1), np.float32), none, marks, neighbours, sharpness)
    counts = np.concatenate(list(_blocks(pa.array(texts, pa.large_binary()))))
    weighted = _unit(np.log1p(counts) * weights)
    axes = latent_axes(weighted, rank, seed)
    return QualityModel(weights, axes, _unit(weighted @ axes), marks, neighbours, sharpness)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    threshold: float = 0.3,
    score: str = "score",
    predicted: str = "predicted",
    **fit,
) -> DataFrame:
    """All rows and columns of ``docs`` with a score of 0 to 1 and, at the threshold, a class.

    Nulls and empty texts score as texts without terms, 0.5; repeated rows score alike; an
    empty table gives an empty result. Columns of ``docs`` that are named like the two results
    are replaced. The id serves only to find the labelled texts.
    """
    model = fit_quality(docs, labels, **fit)
    scored = docs.withColumn(score, model.column(F.col(fit.get("text", "text"))))
    return scored.withColumn(predicted, (F.col(score) >= threshold).cast("int"))
