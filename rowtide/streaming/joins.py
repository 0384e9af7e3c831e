"""The logs of two tables joined while they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.operators.changelog import AFTER_OPS, decode
from rowtide.sources.records import of_table
from rowtide.specs import TableSpec


def joined_logs(
    children: DataFrame,
    parents: DataFrame,
    child: TableSpec,
    parent: TableSpec,
    foreign_key: str,
    columns: list[str],
    *,
    patience: str = "1 hour",
    delay: str = "1 minute",
) -> DataFrame:
    """Each change of a child row with its parent's first row, as both topics arrive: the child's log columns,
    ``lsn``, ``arrived``, the parent's ``columns``, and ``parent_arrived``, null for an orphan.

    ``children`` and ``parents`` are streams of records. A child waits for its parent until ``patience`` after
    its own arrival and is then put out as an orphan; a parent that comes later than that counts in
    ``late_parents``. Time is the broker's, so that old event times are not late; ``delay`` is how much later
    than others a record may be read. A value that says nothing of a row moves time on, too, as a heartbeat
    does; tombstones do not, as they are not read at all.

    State: a child while it waits, and a row for each first row of a parent, which may be asked for at any
    time. A hot parent's children are joined by one task a batch, as state is kept by key. Changes without a
    foreign key and deletes, which may not know theirs, are not joined; ``children``'s own log has them.
    """

    def log(records: DataFrame, spec: TableSpec) -> DataFrame:
        timed = of_table(records, spec).withWatermark("timestamp", delay)
        return decode(timed, spec, extras=("lsn", "timestamp"))

    changes = log(children, child).filter(F.col("op").isin(*AFTER_OPS) & F.col(foreign_key).isNotNull())
    first = log(parents, parent).filter(F.col("op").isin("r", "c"))
    first = first.select(F.col(parent.key[0]).alias("_parent"), *columns, F.col("timestamp").alias("parent_arrived"))
    in_time = F.col("parent_arrived") <= F.col("timestamp") + F.expr(f"INTERVAL {patience}")
    found = changes.join(first, (F.col(foreign_key) == F.col("_parent")) & in_time, "left_outer")
    return found.drop("_parent").withColumnRenamed("timestamp", "arrived")


def with_parents(rows: DataFrame, child: TableSpec, foreign_key: str) -> DataFrame:
    """The joined changes out of a table of ``joined_logs``, each once, with the last of its parent's first
    rows."""
    others = [c for c in rows.columns if c not in (*child.key_columns, "lsn")]
    last = F.max_by(F.struct(*others), "parent_arrived")
    joined = rows.filter("parent_arrived IS NOT NULL")
    return joined.groupBy(*child.key_columns, "lsn").agg(last.alias("row")).select(*child.key_columns, "lsn", "row.*")


def orphaned(rows: DataFrame) -> DataFrame:
    """The changes whose parent had not come in time."""
    return rows.filter("parent_arrived IS NULL").drop("parent_arrived")


def late_parents(rows: DataFrame, parent_log: DataFrame, foreign_key: str, key: str) -> DataFrame:
    """The orphans' parents that did come, too late: the parent's key as ``parent``, and ``n_orphans``."""
    there = parent_log.filter(F.col("op").isin("r", "c")).select(F.col(key).alias("parent")).distinct()
    counted = orphaned(rows).groupBy(F.col(foreign_key).alias("parent")).agg(F.count(F.lit(1)).alias("n_orphans"))
    return counted.join(there, "parent", "left_semi")
