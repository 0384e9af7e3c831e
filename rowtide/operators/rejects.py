"""Records that the change log leaves out, or keeps with nulls, and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowtide.operators.changelog import (
    AFTER_OPS,
    DELETE_OP,
    envelope_part,
    flatten,
    has_envelope,
    parse,
    raw_text,
    row_image,
)
from rowtide.specs import TableSpec

# The reasons, in the order they are looked for. Records of the first four are
# not in the log; records of the others are, with nulls.
LEFT_OUT = ("tombstone", "malformed", "empty_payload", "no_envelope")
KEPT = (
    "no_op",
    "truncate",
    "unknown_op",
    "no_image",
    "no_key",
    "bad_field",
    "decimal_overflow",
    "null_field",
)

# The parts of a table that holds a log and its rejects.
ACCEPTED, FLAGGED, REJECTED = "accepted", "flagged", "rejected"

POSITION = ("topic", "partition", "offset")
_BROKEN = "_broken"


def _either(conditions: list[Column]) -> Column:
    found = F.lit(False)
    for condition in conditions:
        found = found | condition
    return found


def _reason(spec: TableSpec) -> Column:
    """Why a judged row is no plain entry of the log. Decoded values are looked at, not decoded
    again: one that is null where its image has bytes did not fit."""
    image, broken = F.col("_image"), F.col("_broken_text")
    overflow = _either(
        [
            F.col(f"_image.{f.name}").isNotNull() & F.col(f.name).isNull()
            for f in spec.fields
            if f.wire == "decimal"
        ]
    )
    holes = _either([F.col(f.name).isNull() for f in spec.fields if f.not_null])
    return (
        F.when(F.col("json").isNull(), "tombstone")
        .when(~F.col("_envelope") & (F.col("_unread") | broken), "malformed")
        .when(~F.col("_envelope") & F.col("json").rlike(r'"payload"\s*:\s*null'), "empty_payload")
        .when(~F.col("_envelope"), "no_envelope")
        .when(F.col("op").isNull(), "no_op")
        .when(F.col("op") == "t", "truncate")
        .when(~F.col("op").isin(*AFTER_OPS, DELETE_OP), "unknown_op")
        .when(image.isNull(), "no_image")
        .when(_either([F.col(k).isNull() for k in spec.key_columns]), "no_key")
        .when(broken, "bad_field")
        .when(overflow, "decimal_overflow")
        # A delete may carry its key alone.
        .when(F.col("op").isin(*AFTER_OPS) & holes, "null_field")
    )


def judged(
    records: DataFrame,
    spec: TableSpec,
    *,
    strict_wrapped: bool = False,
    precision: str = "second",
    on_overflow: str = "null",
    extras: tuple[str, ...] = (),
) -> DataFrame:
    """Log and rejects in one reading: the columns of the log, the record's position, ``part``,
    ``reason``, and the texts of what is not accepted.

    ``part`` is ``accepted`` for plain entries of the log, ``flagged`` for entries with a reason, and
    ``rejected`` for records that are no entry; so log and rejects are two filters on one table.
    Each record is parsed once and each decimal decoded once; nothing is shuffled.
    """
    position = [n for n in POSITION if n not in extras]
    kept = [n for n in extras if n not in ("lsn", "position", "source")]
    parsed = parse(
        raw_text(records, *position, *kept),
        spec,
        strict_wrapped=strict_wrapped,
        extras=extras,
        corrupt_column=_BROKEN,
    )
    op, before, after = (envelope_part(n, strict_wrapped) for n in ("op", "before", "after"))
    marked = parsed.withColumns(
        {
            "_image": row_image(op, before, after),
            "_envelope": F.coalesce(has_envelope(strict_wrapped), F.lit(False)),
            "_broken_text": F.coalesce(F.col(f"e.{_BROKEN}").isNotNull(), F.lit(False)),
            "_unread": F.col("e").isNull(),
        }
    )
    marks = ("_image", "_envelope", "_broken_text", "_unread")
    rows = flatten(
        marked,
        spec,
        strict_wrapped=strict_wrapped,
        extras=extras,
        precision=precision,
        on_overflow=on_overflow,
        carry=(*position, "key_str", "json", *marks),
    )
    reason = F.col("reason")
    part = (
        F.when(reason.isNull(), ACCEPTED).when(reason.isin(*LEFT_OUT), REJECTED).otherwise(FLAGGED)
    )
    shown = {n: F.when(reason.isNotNull(), F.col(n)) for n in ("key_str", "json")}
    whole = rows.withColumn("reason", _reason(spec)).drop(*marks).withColumns({**shown, "part": part})
    # A generator again: filters on the part and the reason stay above it, instead of being
    # pushed down with a copy of every decode that they stand on.
    return whole.select(F.inline(F.array(F.struct(*whole.columns))))


def log_of(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """The log out of judged rows, without what only rejects need."""
    extra = [c for c in rows.columns if c in ("lsn", "position", "source", "event_date")]
    entries = rows.filter(F.col("part") != REJECTED)
    return entries.select(*spec.log_type().fieldNames(), *extra)


def rejects_of(rows: DataFrame) -> DataFrame:
    """Position, whole texts and reason of the records that are no plain entries."""
    found = rows.filter(F.col("part") != ACCEPTED)
    return found.select(*POSITION, "key_str", "json", "reason")


def rejects(records: DataFrame, spec: TableSpec, *, strict_wrapped: bool = False) -> DataFrame:
    """Position, whole text and ``reason`` of every record that did not reach the log intact.

    It holds neither state nor shuffle, so it runs on a stream. ``judged`` gives the log too.
    """
    return rejects_of(judged(records, spec, strict_wrapped=strict_wrapped))
