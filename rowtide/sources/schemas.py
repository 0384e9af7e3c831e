"""Table specifications read from the messages themselves."""

from __future__ import annotations

import json
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.operators.capture import CONNECT_TYPES
from rowtide.operators.changelog import (
    AFTER_OPS,
    DELETE_OP,
    drop_tombstones,
    flatten,
    has_envelope,
    parse,
    raw_text,
)
from rowtide.specs import Field, TableSpec

_WIRE = {(kind["type"], kind.get("name")): wire for wire, kind in CONNECT_TYPES.items()}

# Which whole numbers and which fractions hold which others.
_WHOLE, _FLOATING = ("short", "int", "long"), ("float", "double")
_DIGITS = {"short": 5, "int": 10, "long": 19}


@dataclass(frozen=True)
class Version:
    """A schema that messages of a topic have: its mark, the table by it, the columns that no wire type is
    known for, and where it was first seen."""

    mark: int
    spec: TableSpec
    unknown: tuple[str, ...]
    first_offset: int


def schema_mark(text: Column) -> Column:
    """A hash of a message's schema part, without parsing it; null for a message without one."""
    part = F.substring_index(text, ',"payload":', 1)
    return F.when(part.startswith('{"schema":{'), F.xxhash64(part))


def field_of(described: dict) -> Field | None:
    """A column by its description in a schema part; none if its type is not known.

    A text stays text, whatever it means; a number with a meaning that is not known (milliseconds, say)
    would be taken for another, so it is not known.
    """
    kind, meaning, name = described["type"], described.get("name"), described["field"]
    not_null = not described.get("optional", False)
    if kind == "string":
        return Field(name, "text", not_null=not_null)
    wire = _WIRE.get((kind, meaning))
    if wire is None:
        return None
    if wire == "decimal":
        given = described.get("parameters", {})
        precision, scale = int(given.get("connect.decimal.precision", 38)), int(given.get("scale", 0))
        return Field(name, wire, precision=precision, scale=scale, not_null=not_null)
    return Field(name, wire, not_null=not_null)


def spec_of(schema: str, topic: str, key_schema: str | None = None) -> tuple[TableSpec, tuple[str, ...]]:
    """The table that a value's schema part (and its key's) describes, and its columns of unknown types."""
    sides = {f.get("field"): f for f in json.loads(schema)["fields"]}
    columns = [(f["field"], field_of(f)) for f in (sides.get("after") or sides["before"])["fields"]]
    fields = tuple(field for _, field in columns if field)
    keys = [f["field"] for f in (json.loads(key_schema) or {}).get("fields", [])] if key_schema else []
    prefix, schema_name, name = topic.rsplit(".", 2)
    spec = TableSpec(name, fields, key=tuple(keys) or ("id",), schema=schema_name, prefix=prefix)
    return spec, tuple(name for name, field in columns if not field)


def schema_versions(records: DataFrame, topic: str) -> list[Version]:
    """The schemas of a topic's messages, in the order they were first seen: a row for each comes to the
    driver."""
    return [Version(r.mark, *spec_of(r.schema, topic, r.key_schema), r.first) for r in first_seen(records, topic).collect()]


def first_seen(records: DataFrame, topic: str) -> DataFrame:
    """The schema parts of the first message of each mark. Tasks reduce their messages to one a mark before the
    shuffle, in a map of a row for each: texts alone would be aggregated by sorting, which holds every message
    of a task."""
    text, key = F.col("value").cast("string"), F.col("key").cast("string")
    return (
        records.filter((F.col("topic") == topic) & F.col("value").isNotNull())
        .select(schema_mark(text).alias("mark"), text.alias("text"), key.alias("key"), "offset")
        .filter("mark IS NOT NULL")
        .groupBy("mark")
        # The set of one mark is what has Spark aggregate in a map.
        .agg(F.collect_set("mark").alias("marks"), F.min_by(F.struct("text", "key"), "offset").alias("one"), F.min("offset").alias("first"))
        .select(F.get("marks", F.lit(0)).alias("mark"), F.get_json_object("one.text", "$.schema").alias("schema"),
                F.get_json_object("one.key", "$.schema").alias("key_schema"), "first")
        .orderBy("first")
    )


def _wider(one: Field, other: Field) -> Field:
    """A column that holds the values of both: whole numbers the longer one, fractions likewise, decimals with
    the digits of both before and behind the point, what has nothing else in common as text."""
    null = replace(one, not_null=one.not_null and other.not_null)
    if one.wire == other.wire != "decimal":
        return null
    for kinds in (_WHOLE, _FLOATING):
        if one.wire in kinds and other.wire in kinds:
            return replace(null, wire=max(one.wire, other.wire, key=kinds.index))
    exact = [f for f in (one, other) if f.wire == "decimal" or f.wire in _WHOLE]
    if len(exact) == 2:
        before = max(_DIGITS.get(f.wire, f.precision - f.scale) for f in exact)
        scale = max(f.scale if f.wire == "decimal" else 0 for f in exact)
        # Messages often leave the precision out, which is then 38. No digit behind the point is given up for
        # that; a value that does not fit before it fails the query.
        return replace(null, wire="decimal", precision=min(before + scale, 38), scale=scale)
    if {one.wire, other.wire} <= {*_WHOLE[:2], *_FLOATING}:
        return replace(null, wire="double")
    return replace(null, wire="text")


def widened(specs: list[TableSpec]) -> TableSpec:
    """One table that holds the rows of all: the last one's columns, then what only earlier ones have. A
    column that not all have may be null."""
    last = specs[-1]
    names = list(dict.fromkeys(n for s in [last, *reversed(specs)] for n in s.columns))
    fields = []
    for name in names:
        there = [s.field(name) for s in specs if name in s.columns]
        field = reduce(_wider, there)
        fields.append(field if len(there) == len(specs) else replace(field, not_null=False))
    return replace(last, fields=tuple(fields))


def _rest(names: tuple[str, ...]) -> Column:
    """The columns of unknown types, as they stand in the row image."""
    if not names:
        return F.lit(None).cast("variant")
    whole = F.try_parse_json("json")
    side = F.when(F.col("op").isin(*AFTER_OPS), "after").when(F.col("op") == DELETE_OP, "before")
    values = [
        F.coalesce(*(
            F.when(side == s, F.try_variant_get(whole, f"$.payload.{s}.{name}", "variant")) for s in ("after", "before")
        )).alias(name)
        for name in names
    ]
    return F.when(side.isNotNull(), F.to_variant_object(F.struct(*values)))


def decode_inferred(
    records: DataFrame, topic: str, versions: list[Version] | None = None, *, extras: tuple[str, ...] = (), **how
) -> tuple[DataFrame, TableSpec]:
    """A topic's change log and the table it is of, without a specification written by hand.

    Each message is decoded by its own schema (a decimal's scale is in there), and its values are cast to
    the widened table. ``rest`` has, as a VARIANT, the columns that no wire type is known for; nothing
    is dropped because it is new. Messages without a schema part are decoded by the last one. ``versions`` are
    looked up in ``records`` unless they are given; a stream needs them, and stops on a schema that is
    not among them. Each version is a filter on the messages' text and a decode of its own; nothing is
    shuffled.
    """
    if versions is None:
        versions = schema_versions(records, topic)
    if not versions:
        raise ValueError(f"no message of {topic} has a schema part; give a specification")
    table = widened([v.spec for v in versions])
    own = records.filter(F.col("topic") == topic)
    kept = [n for n in extras if n not in ("lsn", "position", "source")]
    raw = drop_tombstones(raw_text(own, *kept)).withColumn("mark", schema_mark(F.col("json")))
    known = F.col("mark").isin([v.mark for v in versions])
    stop = F.raise_error(F.lit(f"a schema of {topic} that is not known: look up its versions again"))
    parts = []
    for version in versions:
        mine = F.col("mark") == version.mark
        if version is versions[-1]:
            mine = mine | F.when(F.col("mark").isNull(), True).otherwise(F.when(known, False).otherwise(stop.cast("boolean")))
        parsed = parse(raw.filter(mine), version.spec, extras=tuple(extras))
        log = flatten(
            parsed.filter(has_envelope()), version.spec, extras=tuple(extras), carry=("json",), **how
        ).withColumn("rest", _rest(version.unknown))
        columns = []
        for field in table.log_type():
            there = field.name in log.columns
            columns.append((F.col(field.name) if there else F.lit(None)).cast(field.dataType).alias(field.name))
        parts.append(log.select(*columns, *extras, "rest"))
    return reduce(DataFrame.unionByName, parts), table
