"""Near-duplicates by SimHash: fingerprints that differ in few bits, found by shared blocks."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import stored, texts_of
from rowtide.llm.components import components

BITS = 64
SEED = 42
_WEIGHTS = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
_PART = 100_000


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The SimHash of a text: per bit, whether more than half of the shingles' hashes set it.

    Words are runs of anything but ASCII white space, A to Z in lower case. Shingles are
    ``shingle`` words joined by blanks and count as often as they occur; a text of fewer words is
    one shingle, one without words has fingerprint zero.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    ends = (ends - 1).tolist()
    if len(words) > shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = [0], [len(joined)]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for low in range(0, len(starts), _PART):
        each = zip(starts[low : low + _PART], ends[low : low + _PART], strict=True)
        hashes = np.array([digest(joined[s:e], SEED) for s, e in each], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(_WEIGHTS[2 * ones > len(starts)].sum())


def fingerprints(text: Column, shingle: int = 3) -> Column:
    """The SimHash of a text column as a signed long; null as a text without words."""

    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        found = np.array([fingerprint(t, shingle) for t in texts_of(texts)], np.uint64)
        return pa.array(found.view(np.int64), pa.int64())

    return simhash(text.cast("binary"))


def hexadecimal(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def _blocks(count: int) -> list[tuple[int, int]]:
    """The 64 bits in ``count`` blocks of almost equal length: first bit and length."""
    edges = [round(i * BITS / count) for i in range(count + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:], strict=False)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def near_pairs(
    distinct: DataFrame, *, max_distance: int = 2, blocks: int = 4, crowd: int = 128
) -> DataFrame:
    """Links between different fingerprints that differ in at most ``max_distance`` bits.

    ``distinct`` has one column of different fingerprints. Of ``blocks`` blocks, two such
    fingerprints share at least ``blocks - max_distance``, so each choice of that many blocks is a key; they
    are joined on it and their distance is verified.

    A key that more than ``crowd`` fingerprints have is not joined to all pairs. Its
    fingerprints are equal in the key's bits and are dealt out by the other bits instead: each
    goes to itself and to itself with any one of those bits turned (for distance 1, with any one
    of them blotted out). Two meet there if and only if they are near enough, so one link from
    each to the smallest that it meets joins the same groups as all pairs would. The result
    therefore has a path between the ends of every near pair, not a row for each; every row is
    a verified near pair.
    """
    if not 0 <= max_distance <= 2 or blocks <= max_distance:
        raise ValueError("max_distance is 0, 1 or 2 and smaller than the number of blocks")
    column = distinct.columns[0]
    masks = []
    for chosen in combinations(_blocks(blocks), blocks - max_distance):
        masks.append(sum(((1 << length) - 1) << low for low, length in chosen))
    keys = F.array(
        *(
            F.struct(F.lit(i).alias("part"), F.col(column).bitwiseAND(F.lit(_signed(m))).alias("key"))
            for i, m in enumerate(masks)
        )
    )
    keyed = distinct.select(F.col(column).alias("f"), F.explode(keys).alias("k")).select("f", "k.*")
    shared = keyed.groupBy("part", "key").agg(F.count("*").alias("n")).filter("n > 1")
    keyed = stored(keyed.join(shared, ["part", "key"]), "simhash-blocks")
    few = keyed.filter(F.col("n") <= crowd)
    distance = F.bit_count(F.col("x.f").bitwiseXOR(F.col("y.f")))
    joined = (
        few.alias("x")
        .join(few.alias("y"), ["part", "key"])
        .filter(F.col("x.f") < F.col("y.f"))
        .filter(distance <= max_distance)
        .select(F.col("x.f").alias("a"), F.col("y.f").alias("b"))
    )
    if not max_distance:
        return joined
    crowded = keyed.filter(F.col("n") > crowd)
    dealt = crowded.select("part", "f", F.explode(_neighbours(masks, max_distance)).alias("spot"))
    least = dealt.groupBy("part", "spot").agg(F.min("f").alias("b"))
    stars = (
        dealt.join(least, ["part", "spot"])
        .filter(F.col("f") != F.col("b"))
        .filter(F.bit_count(F.col("f").bitwiseXOR(F.col("b"))) <= max_distance)
        .select(F.col("f").alias("a"), "b")
    )
    return joined.unionByName(stars)


def _neighbours(masks: list[int], max_distance: int) -> Column:
    """Where a fingerprint of a crowded key goes: an array of ``(bit, value)``."""

    def spots(mask: int) -> Column:
        free = [bit for bit in range(BITS) if not mask >> bit & 1]
        value = F.col("f")
        if max_distance == 1:
            return F.array(
                *(
                    F.struct(
                        F.lit(bit).alias("bit"),
                        value.bitwiseAND(F.lit(_signed(~(1 << bit) & (2**64 - 1)))).alias("value"),
                    )
                    for bit in free
                )
            )
        turned = [value.bitwiseXOR(F.lit(_signed(1 << bit))) for bit in free]
        return F.array(
            *(F.struct(F.lit(0).alias("bit"), v.alias("value")) for v in [value, *turned])
        )

    choice = F.lit(None)
    for i, mask in enumerate(masks):
        choice = F.when(F.col("part") == i, spots(mask)) if i == 0 else choice.when(
            F.col("part") == i, spots(mask)
        )
    return choice


def fingerprint_groups(
    fingerprinted: DataFrame, *, ident: str, fingerprint: str, max_distance: int = 2
) -> DataFrame:
    """Of each different fingerprint its group: ``fingerprint, root, component_id``.

    ``root`` is the group's smallest fingerprint, ``component_id`` the smallest id of its
    documents (null if none has an id).
    """
    classes = stored(
        fingerprinted.groupBy(F.col(fingerprint).alias("fingerprint")).agg(F.min(ident).alias("least")),
        "simhash-classes",
    )
    links = near_pairs(classes.select("fingerprint"), max_distance=max_distance)
    roots = components(links)
    placed = classes.join(
        roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left"
    ).select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    placed = stored(placed, "simhash-roots")
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    return placed.join(least, "root").select("fingerprint", "root", "component_id")


def simhash_duplicates(
    docs: DataFrame, *, ident: str = "doc_id", text: str = "text", shingle: int = 3, max_distance: int = 2
) -> DataFrame:
    """One row for each document: its id, ``fingerprint`` (16 hexadecimal digits) and ``component_id``.

    Documents whose fingerprints differ in at most ``max_distance`` bits are linked, equal texts
    and texts without words (null, empty) among them; the component's id is the smallest that
    links lead to. Rows that repeat an id are separate documents; a null id is never a
    component's id unless no document there has one. Other columns are not read.
    """
    narrow = docs.select(F.col(ident), fingerprints(F.col(text), shingle).alias("fingerprint"))
    narrow = stored(narrow, "simhash")
    groups = fingerprint_groups(narrow, ident=ident, fingerprint="fingerprint", max_distance=max_distance)
    return narrow.join(groups, "fingerprint").select(
        ident, hexadecimal(F.col("fingerprint")).alias("fingerprint"), "component_id"
    )


def keep_one_of_each(
    docs: DataFrame, *, ident: str = "doc_id", text: str = "text", shingle: int = 3, max_distance: int = 2
) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: one row of each component.

    It is the one with the smallest id, null last; of rows that repeat that id, the one that
    was read first. Rows are numbered in a written copy, so the choice is made over narrow rows
    and the texts move once, by that number.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    numbered = stored(
        docs.select(
            row,
            F.monotonically_increasing_id().alias("number"),
            fingerprints(F.col(text), shingle).alias("fingerprint"),
        ),
        "simhash-rows",
    )
    narrow = numbered.select(F.col(f"row.`{ident}`").alias("id"), "number", "fingerprint")
    groups = fingerprint_groups(narrow, ident="id", fingerprint="fingerprint", max_distance=max_distance)
    order = F.struct(F.col("id").isNull().alias("last"), "id", "number")
    first = (
        narrow.join(groups, "fingerprint")
        .groupBy("root")
        .agg(F.min(order).alias("first"))
        .select("first.number")
    )
    return numbered.join(first, "number", "left_semi").select("row.*")
