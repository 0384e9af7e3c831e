"""Tables to change events, and change events to change records.

A change is a row with ``op``, ``before`` and ``after`` (structs of the table's columns),
``event_ts`` and ``lsn``, the position in the table's log. A record is what a broker holds.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.functions import encode_decimal, to_micros, to_millis
from rowtide.operators.changelog import DELETE_OP
from rowtide.operators.generate import serial_ids
from rowtide.specs import Field, TableSpec

CHANGE_COLUMNS = ("op", "before", "after", "event_ts", "lsn")

# Names of the types in the schema part of a wrapped message.
CONNECT_TYPES = {
    "int": {"type": "int32"},
    "long": {"type": "int64"},
    "text": {"type": "string"},
    "decimal": {"type": "bytes", "name": "org.apache.kafka.connect.data.Decimal"},
    "timestamp": {"type": "int64", "name": "io.debezium.time.MicroTimestamp"},
    "date": {"type": "int32", "name": "io.debezium.time.Date"},
    "short": {"type": "int16"},
    "double": {"type": "double"},
    "float": {"type": "float"},
    "boolean": {"type": "boolean"},
}


def row_of(spec: TableSpec) -> Column:
    """The columns of a table as one struct."""
    return F.struct(*spec.columns)


def no_row(spec: TableSpec) -> Column:
    """A null of the same type."""
    return F.when(F.lit(False), row_of(spec))


def _changes(
    rows: DataFrame, op: str, before: Column, after: Column, event_ts: Column, lsn: Column
) -> DataFrame:
    values = (F.lit(op), before, after, event_ts, lsn)
    return rows.select(*(v.alias(name) for v, name in zip(values, CHANGE_COLUMNS)))


def snapshot_events(table: DataFrame, spec: TableSpec, event_ts: Column, lsn: Column) -> DataFrame:
    """Every row of a table as a snapshot read."""
    return _changes(table, "r", no_row(spec), row_of(spec), event_ts, lsn)


def diff_events(
    old: DataFrame, new: DataFrame, spec: TableSpec, event_ts: Column, lsn: Column
) -> DataFrame:
    """Changes that lead from one version of a table to the next, by a full join on the key.

    Keys must be there once in each version. Those that are not, or are null, are left out of
    the join, so that no row pairs arise; ``diff_repeats`` reports them, and whether there are any
    is decided on the keys alone. ``event_ts`` and ``lsn`` may use ``row``, the row after the
    change or, at a delete, before it.
    """
    row, key = row_of(spec), list(spec.key)
    repeated = diff_repeats(old, new, spec).select(*key).distinct()
    before, after = (
        version.dropna(subset=key).join(repeated, key, "left_anti").select(*key, row.alias(side))
        for version, side in ((old, "before"), (new, "after"))
    )
    pairs = before.join(after, key, "full")
    changed = pairs.filter(~F.col("before").eqNullSafe(F.col("after")))
    created, deleted = F.col("before").isNull(), F.col("after").isNull()
    op = F.when(created, "c").when(deleted, DELETE_OP).otherwise("u")
    return (
        changed.withColumn("row", F.coalesce("after", "before"))
        .withColumns({"op": op, "event_ts": event_ts, "lsn": lsn})
        .select(*CHANGE_COLUMNS)
    )


def diff_repeats(old: DataFrame, new: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys that stand more than once in a version, or are null, with ``version`` and ``n_rows``.

    ``diff_events`` says nothing of them.
    """
    key = list(spec.key)
    incomplete = F.lit(False)
    for name in key:
        incomplete = incomplete | F.col(name).isNull()
    counted = [
        version.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter((F.col("n_rows") > 1) | incomplete)
        .select(*key, F.lit(name).alias("version"), "n_rows")
        for version, name in ((old, "old"), (new, "new"))
    ]
    return counted[0].unionByName(counted[1])


def insert_events(rows: DataFrame, spec: TableSpec, event_ts: Column, lsn: Column) -> DataFrame:
    """Inserted rows as create events. All sides are known, so nothing is shuffled."""
    return _changes(rows, "c", no_row(spec), row_of(spec), event_ts, lsn)


def update_events(
    table: DataFrame,
    spec: TableSpec,
    where: Column,
    changes: dict[str, Column],
    event_ts: Column,
    lsn: Column,
) -> DataFrame:
    """``UPDATE table SET changes WHERE where`` as update events."""
    unknown = set(changes) - set(spec.columns)
    if unknown:
        raise ValueError(f"{sorted(unknown)} are not columns of {spec.name!r}")
    after = changed_row(table, spec, changes)
    return _changes(table.filter(where), "u", row_of(spec), after, event_ts, lsn)


def delete_events(
    table: DataFrame, spec: TableSpec, where: Column, event_ts: Column, lsn: Column
) -> DataFrame:
    """``DELETE FROM table WHERE where`` as delete events."""
    return _changes(table.filter(where), DELETE_OP, row_of(spec), no_row(spec), event_ts, lsn)


def changed_row(table: DataFrame, spec: TableSpec, changes: dict[str, Column]) -> Column:
    """The columns of a table as one struct, some of them with new values of the same type."""
    return F.struct(
        *(changes.get(c, F.col(c)).cast(table.schema[c].dataType).alias(c) for c in spec.columns)
    )


def key_only(table: DataFrame, spec: TableSpec) -> Column:
    """A row with nothing but its key, as a delete carries it under the default replica
    identity."""
    nothing = {c: F.lit(None) for c in spec.columns if c not in spec.key}
    return changed_row(table, spec, nothing)


def included(
    schema: Column, table: Column, schema_list: str | None = None, table_list: str | None = None
) -> Column:
    """Whether a table is captured. The lists hold regular expressions, parted by commas and
    matched against the whole schema name and the whole ``schema.table`` name."""

    def matches(name: Column, patterns: str | None) -> Column:
        if not patterns:
            return F.lit(True)
        either = "|".join(f"(?:{p.strip()})" for p in patterns.split(","))
        return name.rlike(f"(?i)^(?:{either})$")

    return matches(schema, schema_list) & matches(F.concat_ws(".", schema, table), table_list)


def topic_name(prefix: Column, schema: Column, table: Column) -> Column:
    return F.concat_ws(".", prefix, schema, table)


def _wire(value: Column, field: Field, kind: T.DataType) -> Column:
    if field.wire == "decimal":
        return encode_decimal(value, field.scale, kind.precision)
    if field.wire == "timestamp":
        return to_micros(value, _zoneless(kind))
    if field.wire == "date":
        return F.unix_date(value)
    return value


def _zoneless(kind: T.DataType) -> bool:
    return isinstance(kind, T.TimestampNTZType)


def _wire_image(row: str, spec: TableSpec, kind: T.StructType) -> Column:
    image = F.struct(
        *(
            _wire(F.col(f"{row}.{f.name}"), f, kind[f.name].dataType).alias(f.name)
            for f in spec.fields
        )
    )
    return F.when(F.col(row).isNotNull(), image)


def connect_schema(spec: TableSpec) -> str:
    """The schema part a connector writes with each wrapped value."""

    def described(field: Field) -> dict:
        kind = dict(CONNECT_TYPES[field.wire])
        if field.wire == "decimal":
            kind["parameters"] = {"scale": str(field.scale)}
        return {**kind, "optional": not field.not_null, "field": field.name}

    image = [described(f) for f in spec.fields]
    value = f"{spec.topic}.Value"
    return json.dumps(
        {
            "type": "struct",
            "fields": [
                {"type": "struct", "fields": image, "optional": True, "name": value, "field": side}
                for side in ("before", "after")
            ]
            + [
                {"type": "string", "optional": False, "field": "op"},
                {"type": "int64", "optional": True, "field": "ts_ms"},
            ],
            "optional": False,
            "name": f"{spec.topic}.Envelope",
        },
        separators=(",", ":"),
    )


def in_commit_order(changes: DataFrame, partitions: int | None = None) -> DataFrame:
    """Changes range-partitioned and sorted by log position, over any number of tasks.

    Meant for before ``to_records``, which keeps the order: rows are smaller to move than their
    JSON, and sampling for the ranges does not write the JSON a second time.
    """
    count = () if partitions is None else (partitions,)
    return changes.repartitionByRange(*count, "lsn").sortWithinPartitions("lsn")


def with_offsets(changes: DataFrame, partitions: int | None = None) -> DataFrame:
    """Changes with ``offset``, serial numbers in the order of ``lsn``.

    For changes that share a position, as all rows of a snapshot do: their records would else
    share an offset, too. Rows are range-partitioned and numbered over any number of tasks.
    """
    numbered = serial_ids(changes, ["lsn"], last_id=-1, partitions=partitions)
    return numbered.withColumnRenamed("id", "offset")


def _json(struct: Column) -> Column:
    # Null fields are written: "before":null is part of an envelope. The text of a struct is
    # never null; said so, a filter on that is dropped rather than writing the text for it.
    return F.coalesce(F.to_json(struct, {"ignoreNullFields": "false"}), F.lit(""))


def _message(payload: Column, wrapped: bool, schema: str) -> Column:
    if not wrapped:
        return payload
    return F.concat(F.lit(f'{{"schema":{schema},"payload":'), payload, F.lit("}"))


def to_records(
    changes: DataFrame,
    spec: TableSpec,
    *,
    wrapped: bool = True,
    schema: str = "null",
    partitions: int = 1,
    tombstones: bool = False,
) -> DataFrame:
    """Changes of one table to change records.

    A column ``offset`` gives the offset (see ``with_offsets``). Without it ``lsn`` does: offsets may
    have gaps, so where every change has a position of its own nothing has to be sorted or
    numbered. All changes of a key go to one topic partition.
    Zone-less timestamps are taken as UTC.
    With ``tombstones`` each delete is followed by a record of the same key without a value.
    """
    keys = [F.coalesce(F.col(f"after.{k}"), F.col(f"before.{k}")).alias(k) for k in spec.key]
    at, zoneless = F.col("event_ts"), _zoneless(changes.schema["event_ts"].dataType)
    images = [
        _wire_image(side, spec, changes.schema[side].dataType).alias(side)
        for side in ("before", "after")
    ]
    payload = F.struct(
        *images,
        F.col("op"),
        to_millis(at, zoneless).alias("ts_ms"),
        F.struct(
            F.lit(spec.prefix).alias("name"),
            F.lit(spec.schema).alias("schema"),
            F.lit(spec.name).alias("table"),
            F.col("lsn").alias("lsn"),
        ).alias("source"),
    )
    value = _message(_json(payload), wrapped, schema).cast("binary")
    key = _message(_json(F.struct(*keys)), wrapped, "null").cast("binary")
    partition = F.pmod(F.hash(*keys), F.lit(partitions)).cast("int") if partitions > 1 else F.lit(0)
    rows, offset = changes, F.col("offset" if "offset" in changes.columns else "lsn")
    if tombstones:
        both = F.array(value, F.lit(None).cast("binary"))
        values = F.when(F.col("op") == DELETE_OP, both).otherwise(F.array(value))
        rows = changes.select("*", F.posexplode(values).alias("step", "value"))
        value, offset = F.col("value"), offset * 2 + F.col("step")
    return rows.select(
        key.alias("key"),
        value.alias("value"),
        F.lit(spec.topic).alias("topic"),
        partition.alias("partition"),
        offset.cast("bigint").alias("offset"),
        F.timestamp_micros(to_micros(at, zoneless)).alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
