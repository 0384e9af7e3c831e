"""What a slice of a log changes: net changes of rows, and their effect on joins and counts.

A state here is what ``last_changes`` gives with ``truncates``: a row per key, deleted ones included,
with ``changed_at``, the place of its change, and one for the last truncate.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.operators.state import all_changes
from rowtide.specs import TableSpec


def net_changes(earlier: DataFrame, slice_: DataFrame, spec: TableSpec, cut: DataFrame, *, all_keys: bool = True) -> DataFrame:
    """The state's rows after a slice, for the keys of both, or without ``all_keys`` for those of the slice, with
    ``before`` and ``after``: the table's row as it was and as it is, or null where there is none.

    ``earlier`` need only have the keys of the slice, but all keys if the slice has a truncate; ``cut`` has
    the state's last truncate, if any. The order of changes decides, not the slice they came in, so a
    slice may overlap what came before. Where ``earlier`` has a key several times, as of several batches
    (``batch_id``), the last one is what was there. Both sides meet in one aggregate, which each task begins
    before the shuffle.
    """
    keys = [*spec.key_columns, "truncates"]
    row = F.struct("is_deleted", *spec.columns)
    batch = F.col("batch_id") if "batch_id" in earlier.columns else F.lit(0).cast("long")
    newer, slice_row = all_changes(slice_, spec), F.col("batch").isNull()
    both = (
        earlier.select(*keys, "changed_at", row.alias("row"), batch.alias("batch"))
        .unionByName(newer.select(*keys, "changed_at", row.alias("row"), F.lit(None).cast("long").alias("batch")))
        .groupBy(*keys)
        .agg(
            # Each side's row stands once in what is shuffled.
            F.max_by("row", F.when(slice_row, F.col("changed_at"))).alias("new"),
            F.max(F.when(slice_row, F.col("changed_at"))).alias("new_at"),
            F.max_by("row", "batch").alias("was"),
            F.max(F.when(~slice_row, F.col("changed_at"))).alias("was_at"),
        )
    )
    if not all_keys:
        both = both.filter("new_at IS NOT NULL")
    later = F.col("was_at").isNull() | (F.col("new_at") > F.col("was_at"))
    both = both.select(
        *keys, "was", "was_at",
        F.when(later, F.col("new")).otherwise(F.col("was")).alias("now"),
        F.when(later, F.col("new_at")).otherwise(F.col("was_at")).alias("changed_at"),
    )
    old = cut.agg(F.max("changed_at").alias("at")).scalar()
    new = cut.select("changed_at").unionByName(newer.filter("truncates").select("changed_at"))
    new = new.agg(F.max("changed_at").alias("at")).scalar()

    def live(image: str, at: str, last: Column) -> Column:
        there = ~F.col("truncates") & ~F.col(f"{image}.is_deleted") & (last.isNull() | (F.col(at) > last))
        return F.when(there, F.struct(*(F.col(f"{image}.{c}").alias(c) for c in spec.columns)))

    return both.select(
        *keys,
        "changed_at",
        "now.*",
        live("was", "was_at", old).alias("before"),
        live("now", "changed_at", new).alias("after"),
    )


def signed(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows with ``sign``: what was there, -1, and what is there instead, +1. Rows that stay as they
    were have no part in it."""
    sides = F.array(
        F.struct(F.lit(-1).alias("sign"), F.col("before").alias("row")),
        F.struct(F.lit(1).alias("sign"), F.col("after").alias("row")),
    )
    return (
        changes.filter(~F.col("before").eqNullSafe(F.col("after")))
        .select(F.explode(sides).alias("side"))
        .filter("side.row IS NOT NULL")
        .select("side.sign", *(F.col(f"side.row.{c}").alias(c) for c in spec.columns))
    )


def netted(rows: DataFrame) -> DataFrame:
    """Signed rows without those that cancel each other."""
    columns = [c for c in rows.columns if c != "sign"]
    total = F.sum("sign").cast("int").alias("sign")
    return rows.groupBy(*columns).agg(total).filter("sign <> 0")


def join_changes(
    child_changes: DataFrame,
    child_now: DataFrame,
    parent_changes: DataFrame,
    parent_before: DataFrame,
    foreign_key: str,
    key: str,
    columns: list[str],
) -> DataFrame:
    """Signed rows of the join of child and parent, out of signed rows of both.

    The change of a product: changed children with the parents as they were, and the children as they
    are with changed parents. ``parent_before`` need only have the parents of changed children, and
    ``child_now`` the children of changed parents.
    """

    def parents(rows: DataFrame) -> DataFrame:
        sign = [F.col("sign").alias("_sign")] if "sign" in rows.columns else []
        return rows.select(F.col(key).alias("_parent"), *columns, *sign)

    on = F.col(foreign_key) == F.col("_parent")
    first = child_changes.join(parents(parent_before), on).drop("_parent")
    # A parent whose needed columns stay as they were changes nothing.
    changed = netted(parents(parent_changes).withColumnRenamed("_sign", "sign")).withColumnRenamed("sign", "_sign")
    second = child_now.join(changed, on).drop("_parent").withColumnRenamed("_sign", "sign")
    return netted(first.unionByName(second))


def count_change(changes: DataFrame) -> DataFrame:
    """How many rows more (or fewer) the table has: one row, ``n_rows``."""
    more = F.col("after").isNotNull().cast("long") - F.col("before").isNotNull().cast("long")
    return changes.agg(F.coalesce(F.sum(more), F.lit(0)).cast("long").alias("n_rows"))
