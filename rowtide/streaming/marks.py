"""Redelivered records told by one position a key."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rowtide.specs import TableSpec

# How a change arrived. New; again; or behind a later change of its key that was there
# before, which is a repeat or comes late.
NEW, REPEAT, BEHIND = "new", "repeat", "behind"

BUCKETS = 8192  # rows of state that keys are dealt to


def _packed(field: T.StructField) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, T.TimestampType):
        column = F.unix_micros(column)
    return column.cast("string")


def _unpacked(field: T.StructField, place: int) -> Column:
    value = F.get("row", F.lit(place))
    if isinstance(field.dataType, T.TimestampType):
        return F.timestamp_micros(value.cast("long")).alias(field.name)
    return value.cast(field.dataType).alias(field.name)


def _mark(bucket: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """How each change of a bucket's keys arrived, against the highest position of its key before the batch
    and those in it."""
    marks = dict(zip(*state.get, strict=True)) if state.exists else {}
    tops, here = dict(marks), set()
    for frame in frames:
        said = []
        for key, place in zip(frame["key"].tolist(), frame["lsn"].tolist(), strict=True):
            mark = marks.get(key)
            if mark is not None and place <= mark:
                said.append(REPEAT if place == mark else BEHIND)
            elif (key, place) in here:
                said.append(REPEAT)
            else:
                here.add((key, place))
                said.append(NEW)
                if (top := tops.get(key)) is None or place > top:
                    tops[key] = place
        yield pd.DataFrame({"row": frame["row"], "arrival": said})
    if here:
        state.update((list(tops), list(tops.values())))


def with_arrival(log: DataFrame, spec: TableSpec, *, buckets: int = BUCKETS) -> DataFrame:
    """A streamed log, with ``lsn``, and how each change arrived: ``arrival``.

    The state is one position a key, the highest so far, whatever the number of changes and without a
    horizon. A change above it is ``new``; the same position again, or one that came before in its batch, is
    a ``repeat``. One below it is ``behind``: the source sends the changes of a key in order, so it is
    nearly always a repeat, but it may come late; ``once`` tells these apart when the table is read, so
    that nothing is lost. Changes without a key or a position are ``new``: nothing tells them from others.

    Rows go through Python in Arrow batches, as text, which is exact for all types of a log. Keys are told
    in ``buckets`` by their hash, each a row of state with its keys and their positions: Python is called once a
    bucket and batch, not once a key. The changes of one bucket in one batch are seen by one task, as rows of a
    stream; only keys and positions are held. The number of buckets stays with the checkpoint.
    """
    fields = log.schema.fields
    if any(isinstance(f.dataType, T.MapType) for f in fields):
        raise ValueError("the whole source part cannot be carried; keep lsn or position")
    keys = {f"_key_{k}": F.coalesce(F.col(f"pk_{k}"), F.col(k)) for k in spec.key}
    row = F.array(*map(_packed, fields)).alias("row")
    packed = log.select(*(c.alias(n) for n, c in keys.items()), "lsn", row)
    told = F.col("lsn").isNotNull()
    for name in keys:
        told = told & F.col(name).isNotNull()
    texts = F.array(*(_packed(packed.schema[name]) for name in keys))
    marked = (
        packed.filter(told)
        .select(F.to_json(texts).alias("key"), "lsn", "row")
        .withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInPandasWithState(
            _mark, "row array<string>, arrival string", "keys array<string>, places array<long>", "append", GroupStateTimeout.NoTimeout
        )
    )
    others = packed.filter(~told).select("row", F.lit(NEW).alias("arrival"))
    unpacked = [_unpacked(f, place) for place, f in enumerate(fields)]
    return marked.unionByName(others).select(*unpacked, "arrival")


def once(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """The log without repeats, out of a table with ``arrival``: new changes, and of those behind
    the ones that are not among them, once each.

    Those behind are few beside the table, which is cut to their keys before the two meet.
    """
    new, behind = (rows.filter(F.col("arrival") == a).drop("arrival") for a in (NEW, BEHIND))
    place = [*spec.key_columns, "op", "lsn"]
    some = behind.dropDuplicates(place)
    there = new.select(*place).join(behind.select(*place).distinct(), place, "left_semi")
    return new.unionByName(some.join(there, place, "left_anti"))


def arrivals(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """How many changes arrived in each way, and how many of those behind came late: ``arrival``, ``n_changes``."""
    counts = rows.groupBy("arrival").agg(F.count(F.lit(1)).alias("n_changes"))
    place = [*spec.key_columns, "op", "lsn"]
    new, behind = (rows.filter(F.col("arrival") == a).select(*place).distinct() for a in (NEW, BEHIND))
    late = behind.join(new, place, "left_anti").agg(F.count(F.lit(1)).alias("n_changes"))
    return counts.unionByName(late.select(F.lit("late").alias("arrival"), "n_changes").filter("n_changes > 0"))
