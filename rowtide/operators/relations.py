"""Joins between tables, and what foreign keys and unique keys ask for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_parent(
    child: DataFrame, parent: DataFrame, foreign_key: str, columns: list[str], key: str = "id"
) -> DataFrame:
    """Child rows with columns of their parent, by inner join.

    The parent is cut to what is needed before the join. It is not broadcast: Spark estimates its size by
    the files it was made from, which are compressed and say nothing of a log decoded from them, and a
    parent that is larger than that would have to fit the driver. A parent with very many children is
    split by the adaptive skew join, which the unique parent key allows.
    """
    looked_up = parent.select(F.col(key).alias("_parent"), *columns).hint("merge")
    return child.join(looked_up, child[foreign_key] == looked_up["_parent"], "inner").drop(
        "_parent"
    )


def orphans(child: DataFrame, parent: DataFrame, foreign_key: str, key: str = "id") -> DataFrame:
    """Child rows whose parent does not exist. A null foreign key refers to nothing and is no
    violation."""
    present = parent.select(F.col(key).alias("_parent"))
    return child.filter(F.col(foreign_key).isNotNull()).join(
        present, child[foreign_key] == present["_parent"], "left_anti"
    )


def cascade_deleted(
    child: DataFrame, deleted_parents: DataFrame, foreign_key: str, key: str = "id"
) -> DataFrame:
    """Child rows that go with their deleted parents."""
    gone = deleted_parents.select(F.col(key).alias("_parent"))
    return child.join(gone, child[foreign_key] == gone["_parent"], "left_semi")


def cascade_survivors(
    child: DataFrame, deleted_parents: DataFrame, foreign_key: str, key: str = "id"
) -> DataFrame:
    """Child rows that stay when parents are deleted."""
    gone = deleted_parents.select(F.col(key).alias("_parent"))
    return child.join(gone, child[foreign_key] == gone["_parent"], "left_anti")


def insert_if_absent(
    existing: DataFrame, incoming: DataFrame, unique: str, arrival: list[str | Column]
) -> DataFrame:
    """Incoming rows to add: the first arrival of each key that the table does not hold.

    The table's keys are first cut to those that arrive, by a semi join whose other side, the
    arriving keys, is the small one: where it is small enough Spark broadcasts it and the
    table is not shuffled, else its keys alone are. The few that are held then leave the
    arrivals by an anti join. Repeats are reduced before the shuffle. Rows without the key
    cannot be inserted; ``null_violations`` lists them.
    """
    columns = incoming.columns
    others = [c for c in columns if c != unique]
    first = F.min_by(F.struct(*others), F.struct(*arrival))
    firsts = (
        incoming.filter(F.col(unique).isNotNull())
        .groupBy(unique)
        .agg(first.alias("_row"))
        .select(unique, "_row.*")
    )
    arriving = incoming.select(unique).dropna().distinct()
    held = existing.select(unique).join(arriving, unique, "left_semi").distinct()
    return firsts.join(held, unique, "left_anti").select(*columns)
