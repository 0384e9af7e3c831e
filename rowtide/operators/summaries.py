"""Summaries of tables that are kept beside them: sums of row hashes by key, and the set of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.operators.capture import diff_events
from rowtide.specs import TableSpec

DEPTH = 16  # two to its power are the leaves of a summary


def leaf_of(key: list[str], depth: int) -> Column:
    """The leaf of the hash tree that a key belongs to."""
    return F.shiftrightunsigned(F.xxhash64(*key), 64 - depth).cast("int")


def row_hashes(columns: list[str]) -> list[Column]:
    """Two 64-bit hashes of a row. Null is told from other values, wherever it stands."""
    nulls = F.array(*(F.col(c).isNull() for c in columns))
    one = F.xxhash64(nulls, *columns)
    return [one, F.xxhash64(F.lit("second"), one, nulls, *reversed(columns))]


def summary(table: DataFrame, spec: TableSpec, *, depth: int = DEPTH) -> DataFrame:
    """A table's leaves: ``leaf``, ``n_rows``, ``sum_1``, ``sum_2``, as sums of row hashes that no order of rows
    changes.

    Each task adds up its rows before the shuffle, so what is shuffled are leaves. Tables of equal summaries
    are equal, but for hashes of 128 bits that come to the same. Choose ``depth`` so that a leaf has some
    hundreds or thousands of rows.
    """
    one, two = row_hashes(spec.columns)
    wide = "decimal(38,0)"
    return table.groupBy(leaf_of(list(spec.key), depth).alias("leaf")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(one.cast(wide)).alias("sum_1"),
        F.sum(two.cast(wide)).alias("sum_2"),
    )


def rolled_up(leaves: DataFrame, levels: int) -> DataFrame:
    """The nodes ``levels`` above, out of a summary."""
    node = F.shiftrightunsigned("leaf", levels).cast("int")
    sums = (F.sum(c).cast("decimal(38,0)").alias(c) for c in ("sum_1", "sum_2"))
    return leaves.groupBy(node.alias("leaf")).agg(F.sum("n_rows").alias("n_rows"), *sums)


def differing_leaves(old: DataFrame, new: DataFrame, *, levels: tuple[int, ...] = (8,)) -> DataFrame:
    """The leaves, ``leaf``, in which two summaries differ, found downwards: leaves are only compared below
    nodes that differ, ``levels`` above them, the highest first."""
    for up in sorted(levels, reverse=True):
        node = F.shiftrightunsigned("leaf", up).cast("int")
        found = _differing(rolled_up(old, up), rolled_up(new, up)).withColumnRenamed("leaf", "_node")
        old, new = (
            side.withColumn("_node", node).join(found, "_node", "left_semi").drop("_node")
            for side in (old, new)
        )
    return _differing(old, new)


def _differing(old: DataFrame, new: DataFrame) -> DataFrame:
    values = ("n_rows", "sum_1", "sum_2")
    renamed = new.select("leaf", *(F.col(v).alias(f"_{v}") for v in values))
    same = F.lit(True)
    for value in values:
        same = same & F.col(value).eqNullSafe(F.col(f"_{value}"))
    return old.join(renamed, "leaf", "full").filter(~same).select("leaf")


def diff_by_summary(
    old: DataFrame,
    new: DataFrame,
    spec: TableSpec,
    event_ts: Column,
    lsn: Column,
    *,
    depth: int = DEPTH,
    levels: tuple[int, ...] = (8,),
    old_summary: DataFrame | None = None,
    new_summary: DataFrame | None = None,
) -> DataFrame:
    """The same changes as ``diff_events``, of versions that differ in few rows.

    The versions' summaries, stored ones if they are given, say in which leaves they differ; only the rows of
    these are shuffled and compared by value. All rows of a key are in one leaf, so repeats are told
    there as they are in the whole.
    """
    old_summary = summary(old, spec, depth=depth) if old_summary is None else old_summary
    new_summary = summary(new, spec, depth=depth) if new_summary is None else new_summary
    leaves = differing_leaves(old_summary, new_summary, levels=levels)
    leaf = leaf_of(list(spec.key), depth)
    changed = (
        version.withColumn("leaf", leaf).join(leaves, "leaf", "left_semi").drop("leaf") for version in (old, new)
    )
    return diff_events(*changed, spec, event_ts, lsn)


def key_bitmap(rows: DataFrame, key: str) -> DataFrame:
    """The set of a table's whole-number keys, exactly: ``bucket``, ``bits``, a bit for each of the 32,768
    numbers of a bucket. Each task makes its own bits before the shuffle."""
    number = F.col(key).cast("long")
    return (
        rows.filter(number.isNotNull())
        .groupBy(F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))
    )


def extended_bitmap(bitmap: DataFrame, added: DataFrame, key: str) -> DataFrame:
    """A stored set with the keys of added rows; the table is not read. Keys do not leave the set, as the
    numbers of a serial key are not used again."""
    return bitmap.unionByName(key_bitmap(added, key)).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def _in_bitmap(rows: DataFrame, bitmap: DataFrame, key: str) -> DataFrame:
    """``rows`` with ``_there``, whether the key is in the set; null for a null key."""
    number = F.col(key).cast("long")
    place = F.bitmap_bit_position(number)
    held = bitmap.select(F.col("bucket").alias("_bucket"), F.col("bits").alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit = F.getbit(F.coalesce(byte, F.lit(0)), (place % 8).cast("int")) == 1
    joined = rows.join(held, F.bitmap_bucket_number(number) == F.col("_bucket"), "left")
    return joined.withColumn("_there", F.when(number.isNotNull(), bit)).drop("_bucket", "_bits")


def orphans_by_bitmap(child: DataFrame, parents: DataFrame, foreign_key: str) -> DataFrame:
    """Child rows whose parent is not in the set ``parents``; as ``orphans``, without reading the parents."""
    return _in_bitmap(child, parents, foreign_key).filter(~F.col("_there")).drop("_there")


def absent_by_bitmap(rows: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the set ``held``, all of them where several share it. Rows without a key are
    left out."""
    return _in_bitmap(rows, held, key).filter(~F.col("_there")).drop("_there")
