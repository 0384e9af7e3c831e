"""Change records to a typed change log.

Every step is a projection or a filter: no shuffle, no state, no Python worker. The same
code serves a batch of records and a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.functions import decode_decimal, from_micros, from_millis
from rowtide.specs import Field, TableSpec

# Operation codes of an envelope. Snapshot read, create and update carry
# the row after the change, delete carries the row before it.
AFTER_OPS = ("c", "u", "r")
DELETE_OP = "d"

# Columns a log can keep beside its own, to order changes or to trace them.
EXTRAS = ("lsn", "position", "source", "topic", "partition", "offset", "timestamp")

# Extras that are read of the envelope's source part. A position that is no whole number has no
# ``lsn``; ``position`` keeps it as text.
_OF_SOURCE = ("lsn", "position", "source")


def raw_text(records: DataFrame, *extras: str) -> DataFrame:
    """Key and value as text, other columns as asked for."""
    return records.select(
        F.col("key").cast("string").alias("key_str"),
        F.col("value").cast("string").alias("json"),
        *extras,
    )


def drop_tombstones(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("json").isNotNull())


def _payload_fields(
    spec: TableSpec, extras: tuple[str, ...], columns: list[str] | None = None
) -> list[T.StructField]:
    image = spec.image_type()
    if columns is not None:
        image = T.StructType([f for f in image if f.name in columns])
    images = [T.StructField(side, image) for side in ("before", "after") if image.fields]
    fields = [
        *images,
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ]
    if "source" in extras:
        fields.append(T.StructField("source", T.MapType(T.StringType(), T.StringType())))
    elif "lsn" in extras or "position" in extras:
        # As text, so that a number and a quoted number are both accepted.
        position = T.StructType([T.StructField("lsn", T.StringType())])
        fields.append(T.StructField("source", position))
    return fields


def key_schema(spec: TableSpec, strict_wrapped: bool = False) -> T.StructType:
    key = spec.key_type()
    wrapped = [T.StructField("payload", key)]
    return T.StructType(wrapped if strict_wrapped else wrapped + key.fields)


def envelope_schema(
    spec: TableSpec,
    strict_wrapped: bool = False,
    extras: tuple[str, ...] = (),
    columns: list[str] | None = None,
) -> T.StructType:
    """What is read of a value. The wrapped form has the envelope under ``payload``, the plain
    form at the root; one schema takes both. The ``schema`` part is not read at all, nor are
    columns of the row images that are not asked for."""
    payload = _payload_fields(spec, extras, columns)
    wrapped = [T.StructField("payload", T.StructType(payload))]
    return T.StructType(wrapped if strict_wrapped else wrapped + payload)


def parse(
    raw: DataFrame,
    spec: TableSpec,
    *,
    strict_wrapped: bool = False,
    extras: tuple[str, ...] = (),
    columns: list[str] | None = None,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Add the parsed key ``k`` and envelope ``e``.

    Both are parsed inside a generator. A filter on the result then stays above the parse;
    over a plain projection Catalyst would push a second copy of the parse below it.
    """
    envelope = envelope_schema(spec, strict_wrapped, extras, columns)
    options = {}
    if corrupt_column:
        envelope = envelope.add(corrupt_column, T.StringType())
        options["columnNameOfCorruptRecord"] = corrupt_column
    parsed = F.struct(
        F.from_json("key_str", key_schema(spec, strict_wrapped)).alias("k"),
        F.from_json("json", envelope, options).alias("e"),
    )
    return raw.select("*", F.inline(F.array(parsed)))


def envelope_part(name: str, strict_wrapped: bool = False) -> Column:
    """A part of the envelope, from wherever it stands."""
    if strict_wrapped:
        return F.col(f"e.payload.{name}")
    return F.when(F.col("e.payload").isNotNull(), F.col(f"e.payload.{name}")).otherwise(
        F.col(f"e.{name}")
    )


def has_envelope(strict_wrapped: bool = False) -> Column:
    wrapped = F.col("e.payload").isNotNull()
    return wrapped if strict_wrapped else wrapped | F.col("e.op").isNotNull()


def row_image(op: Column, before: Column, after: Column) -> Column:
    """The row a change speaks of; null for an unknown operation."""
    return F.when(op.isin(*AFTER_OPS), after).when(op == DELETE_OP, before)


def key_part(name: str, strict_wrapped: bool = False) -> Column:
    """A key column. A null key keeps its row, with a null here."""
    if strict_wrapped:
        return F.col(f"k.payload.{name}")
    return F.when(F.col("k.payload").isNotNull(), F.col(f"k.payload.{name}")).otherwise(
        F.col(f"k.{name}")
    )


def delete_flag(op: Column) -> Column:
    return op == DELETE_OP


def typed(value: Column, field: Field, precision: str, on_overflow: str) -> Column:
    """A wire value as its log type."""
    if field.wire == "decimal":
        return decode_decimal(value, field.precision, field.scale, on_overflow)
    if field.wire == "timestamp":
        return from_micros(value, precision)
    if field.wire == "date":
        return F.date_from_unix_date(value)
    return value


def flatten(
    parsed: DataFrame,
    spec: TableSpec,
    *,
    strict_wrapped: bool = False,
    extras: tuple[str, ...] = (),
    precision: str = "second",
    on_overflow: str = "fail",
    columns: list[str] | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Parsed records to the columns of the log."""
    fields = [f for f in spec.fields if columns is None or f.name in columns]
    op, ts_ms = (envelope_part(name, strict_wrapped) for name in ("op", "ts_ms"))
    images = []
    if fields:
        before, after = (envelope_part(name, strict_wrapped) for name in ("before", "after"))
        images.append(row_image(op, before, after).alias("image"))
    picked = parsed.select(
        *(key_part(n, strict_wrapped).alias(f"pk_{n}") for n in spec.key),
        op.alias("op"),
        *images,
        from_millis(ts_ms).alias("event_ts"),
        *_extra_columns(extras, strict_wrapped),
        *carry,
    )
    return picked.select(
        *spec.key_columns,
        "op",
        *(
            typed(F.col(f"image.{f.name}"), f, precision, on_overflow).alias(f.name)
            for f in fields
        ),
        "event_ts",
        delete_flag(F.col("op")).alias("is_deleted"),
        *extras,
        *carry,
    )


def _extra_columns(extras: tuple[str, ...], strict_wrapped: bool) -> list[Column]:
    columns = []
    for name in extras:
        if name == "lsn":
            source = envelope_part("source", strict_wrapped)
            columns.append(source["lsn"].try_cast("bigint").alias("lsn"))
        elif name == "position":
            columns.append(envelope_part("source", strict_wrapped)["lsn"].alias("position"))
        elif name == "source":
            columns.append(envelope_part("source", strict_wrapped).alias("source"))
        else:
            columns.append(F.col(name))
    return columns


def decode(
    records: DataFrame,
    spec: TableSpec,
    *,
    strict_wrapped: bool = False,
    precision: str = "second",
    on_overflow: str = "fail",
    extras: tuple[str, ...] = (),
    columns: list[str] | None = None,
) -> DataFrame:
    """Change records of one table to its change log.

    An update adds a row and a delete adds a row marked ``is_deleted``; tombstones and values
    without an envelope are left out (``rejects`` reports them). ``strict_wrapped`` takes the
    ``{"schema", "payload"}`` form only. ``precision`` is that of the table's own timestamps.
    ``extras`` appends any of ``lsn, position, source, topic, partition, offset, timestamp``.
    ``columns`` names the table's columns that are needed; the parser does not read the others.
    """
    extras = tuple(extras)
    unknown = set(extras) - set(EXTRAS)
    if unknown:
        raise ValueError(f"unknown extra columns {sorted(unknown)}")
    missing = set(columns or ()) - set(spec.columns)
    if missing:
        raise ValueError(f"{sorted(missing)} are not columns of {spec.name!r}")
    kept = [name for name in extras if name not in _OF_SOURCE]
    raw = drop_tombstones(raw_text(records, *kept))
    parsed = parse(raw, spec, strict_wrapped=strict_wrapped, extras=extras, columns=columns)
    return flatten(
        parsed.filter(has_envelope(strict_wrapped)),
        spec,
        strict_wrapped=strict_wrapped,
        extras=extras,
        precision=precision,
        on_overflow=on_overflow,
        columns=columns,
    )
