"""The rows of a table, now or at a time, out of its change log."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowtide.functions import utc_date
from rowtide.operators.changelog import AFTER_OPS, DELETE_OP
from rowtide.specs import TableSpec

# What orders the changes of one key, strongest first. The log position decides; arrival
# on the topic settles changes that share one, and then the event time.
ORDER = ("lsn", "offset", "event_ts")
TEXT_ORDER = ("position", "offset", "event_ts")
TRUNCATE_OP = "t"


def natural(text: Column) -> Column:
    """A text's order where runs of digits count as numbers: ``file.9`` before ``file.10``."""
    digits = lambda run: F.regexp_replace(run, r"^0+(?=\d)", "")
    number = lambda run: F.concat(F.lpad(F.length(digits(run)).cast("string"), 4, "0"), digits(run))
    runs = F.regexp_extract_all(text, F.lit(r"(\d+|\D+)"), F.lit(1))
    return F.when(text.isNotNull(), F.transform(runs, lambda run: F.when(run.rlike(r"^\d"), number(run)).otherwise(run)))


def _order_names(
    log: DataFrame, spec: TableSpec, order_by: tuple[str, ...] | None
) -> tuple[str, ...]:
    if order_by:
        return tuple(order_by)
    usual = ORDER if spec.position == "number" else TEXT_ORDER
    if usual[0] not in log.columns:
        raise ValueError(f"the log has no {usual[0]} to order changes by; keep it, or give order_by")
    return tuple(n for n in usual if n in log.columns)


def change_order(
    log: DataFrame, spec: TableSpec, order_by: tuple[str, ...] | None = None
) -> Column:
    """The order of changes as one value that is never null, since ``max_by`` passes over nulls.

    A change without the position, or without any column that ``order_by`` names, cannot be placed
    among the others and fails the query, rather than give a state by accident.
    """
    names = _order_names(log, spec, order_by)
    needed = names if order_by else names[:1]

    def place(name: str) -> Column:
        value, kind = F.col(name), log.schema[name].dataType
        if name in needed:
            missing = f"a change without {name}: it cannot be ordered; give order_by"
            value = F.coalesce(value, F.raise_error(F.lit(missing)).cast(kind))
        if name == "position" and spec.position != "text":
            value = natural(value)
        return value.alias(name)

    return place(names[0]) if len(names) == 1 else F.struct(*map(place, names))


def keyed(log: DataFrame, spec: TableSpec) -> DataFrame:
    """Changes that say something of a row: a known operation, and a key in the record's key
    or, where that is missing, in the row image."""
    keys = {f"pk_{k}": F.coalesce(F.col(f"pk_{k}"), F.col(k)) for k in spec.key}
    rows = log.filter(F.col("op").isin(*AFTER_OPS, DELETE_OP)).withColumns(keys)
    return rows.dropna(subset=spec.key_columns)


def _live(log: DataFrame, spec: TableSpec, order: Column) -> DataFrame:
    """The changes of rows after the last truncate of the table, or all of them if there is none.

    The truncate's place is one value, found by a scan of the operations and the order alone. A
    stream cannot look ahead for it and fails on a truncate instead of keeping rows that are gone;
    ``last_changes`` with ``truncates`` gives it along.
    """
    truncate = F.col("op") == TRUNCATE_OP
    if log.isStreaming:
        stop = F.raise_error(F.lit("a truncate in the log: keep it with the state, or use a batch"))
        return keyed(log.filter(F.when(truncate, stop.cast("boolean")).otherwise(F.lit(True))), spec)
    last = log.filter(truncate).agg(F.max(order).alias("last")).scalar()
    return keyed(log, spec).filter(last.isNull() | (order > last))


def last_changes(
    log: DataFrame,
    spec: TableSpec,
    *,
    columns: list[str] | None = None,
    order_by: tuple[str, ...] | None = None,
    truncates: bool = False,
) -> DataFrame:
    """The last change of every key since the last truncate, deletes included.

    An aggregate, not a window: each task reduces its rows to one per key before the shuffle,
    so a key with very many changes is spread over the tasks that read it, and it runs on a stream
    too. The rows are sorted for that on either side of the shuffle; ``compacted`` keeps the log
    that has to be sorted short.

    With ``truncates`` nothing is looked up ahead, so that a stream keeps running: the last truncate is one
    more row, without a key, and ``changed_at`` says where in the log each row's change stands.
    ``after_truncate`` takes from them what is there.
    """
    carried = spec.columns if columns is None else columns
    order = change_order(log, spec, order_by)
    row = F.struct(F.col("is_deleted"), *carried)
    if not truncates:
        rows = _live(log, spec, order).groupBy(*spec.key_columns)
        return rows.agg(F.max_by(row, order).alias("row")).select(*spec.key_columns, "row.*")
    last = all_changes(log, spec, order_by=order_by).groupBy(*spec.key_columns, "truncates").agg(
        F.max_by(row, "changed_at").alias("row"), F.max("changed_at").alias("changed_at")
    )
    return last.select(*spec.key_columns, "truncates", "changed_at", "row.*")


def all_changes(log: DataFrame, spec: TableSpec, *, order_by: tuple[str, ...] | None = None) -> DataFrame:
    """The changes of rows and the truncates (``truncates``, without a key), with ``changed_at``, where in the log
    each stands."""
    cut, order = F.col("op") == TRUNCATE_OP, change_order(log, spec, order_by)
    keys = {f"pk_{k}": F.when(~cut, F.coalesce(F.col(f"pk_{k}"), F.col(k))) for k in spec.key}
    whole = cut | F.concat(*(F.col(k).cast("string") for k in spec.key_columns)).isNotNull()
    rows = log.filter(F.col("op").isin(*AFTER_OPS, DELETE_OP, TRUNCATE_OP)).withColumns(keys).filter(whole)
    return rows.withColumns({"truncates": cut, "changed_at": order})


def after_truncate(rows: DataFrame) -> DataFrame:
    """The rows that no truncate took, out of ``last_changes`` with ``truncates``. The last truncate is
    one value, whatever came in between."""
    last = rows.filter("truncates").agg(F.max("changed_at").alias("last")).scalar()
    live = rows.filter(~F.col("truncates") & (last.isNull() | (F.col("changed_at") > last)))
    return live.drop("truncates", "changed_at")


def current_state(
    log: DataFrame,
    spec: TableSpec,
    *,
    columns: list[str] | None = None,
    order_by: tuple[str, ...] | None = None,
) -> DataFrame:
    """The table as its log leaves it: the last change per key, without deleted rows, and
    nothing from before a truncate.

    ``columns`` names the columns that are needed; the others are neither read nor shuffled.
    The log must have its positions (``lsn``, or ``position`` where the specification says that they are
    text), unless ``order_by`` says what else orders it; a change without one fails the query.
    """
    carried = spec.columns if columns is None else columns
    last = last_changes(log, spec, columns=carried, order_by=order_by)
    return last.filter(~F.col("is_deleted")).select(*carried)


def compacted(
    log: DataFrame, spec: TableSpec, *, order_by: tuple[str, ...] | None = None
) -> DataFrame:
    """The log cut to what later states need: the last change of every key, and the last
    truncate. It is a log again, so ``current_state`` of it is that of the whole log."""
    order = change_order(log, spec, order_by)
    last = F.max_by(F.struct(*log.columns), order).alias("row")
    rows = _live(log, spec, order).groupBy(*spec.key_columns).agg(last)
    truncates = log.filter(F.col("op") == TRUNCATE_OP).agg(last).filter(F.col("row").isNotNull())
    return rows.select("row.*").unionByName(truncates.select("row.*"))


def fold(
    earlier: DataFrame, later: DataFrame, spec: TableSpec, *, order_by: tuple[str, ...] | None = None
) -> DataFrame:
    """An earlier fold (or log) and the slice of the log that came since, as one compacted log.

    Only the slice and the earlier fold are read, however long the log has grown. A slice may
    overlap what was folded before: the order decides, not the arrival.
    """
    return compacted(earlier.unionByName(later), spec, order_by=order_by)


def state_for_sql(
    log: DataFrame, spec: TableSpec, *, order_by: tuple[str, ...] | None = None
) -> DataFrame:
    """The same rows as ``current_state``, as a plan for views.

    A statement's own choice of columns reaches the scan through a window, where it would stop
    at an aggregate of whole rows. The limit of one row per key is applied in each task before
    the shuffle, too. Windows of this kind do not run on streams.
    """
    order = change_order(log, spec, order_by)
    latest_first = W.partitionBy(*spec.key_columns).orderBy(order.desc())
    return (
        _live(log, spec, order)
        .withColumn("_place", F.row_number().over(latest_first))
        .filter((F.col("_place") == 1) & ~F.col("is_deleted"))
        .select(*spec.columns)
    )


def count_rows(
    log: DataFrame, spec: TableSpec, *, order_by: tuple[str, ...] | None = None
) -> DataFrame:
    """Number of rows in the current table.

    Carries only the delete flag, so with ``lsn`` as the only order the aggregate stays a hash
    aggregate on fixed-width buffers.
    """
    order = change_order(log, spec, order_by)
    flag = F.max_by("is_deleted", order).alias("is_deleted")
    last = _live(log, spec, order).groupBy(*spec.key_columns).agg(flag)
    return last.filter(~F.col("is_deleted")).agg(F.count(F.lit(1)).alias("n_rows"))


def state_as_of(
    log: DataFrame,
    spec: TableSpec,
    at: datetime | Column,
    *,
    columns: list[str] | None = None,
    order_by: tuple[str, ...] | None = None,
) -> DataFrame:
    """The table as it stood at a time. On a log kept by event date later dates are not read."""
    moment = at if isinstance(at, Column) else F.lit(at)
    until = F.col("event_ts") <= moment
    if "event_date" in log.columns:
        until = until & (F.col("event_date") <= utc_date(moment.cast("timestamp")))
    return current_state(log.filter(until), spec, columns=columns, order_by=order_by)


def change_place(log: DataFrame) -> Column:
    """What tells a change from another when its record is sent again: its position, as a number
    or else as text. A record without any is told by where it stands on the topic."""
    position = [F.col(n).cast("string") for n in ("lsn", "position") if n in log.columns]
    position = F.coalesce(*position) if position else F.lit(None).cast("string")
    arrival = [n for n in ("topic", "partition", "offset") if n in log.columns]
    if "offset" in arrival:
        place = F.concat_ws("/", F.lit("arrival"), *arrival)
    elif log.isStreaming:
        place = F.raise_error(F.lit("a change without position; carry partition and offset"))
    else:
        place = F.concat(F.lit("row/"), F.monotonically_increasing_id().cast("string"))
    return F.when(position.isNotNull(), F.concat(F.lit("at/"), position)).otherwise(
        place.cast("string")
    )


def drop_redelivered(log: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per change, however often its record was sent.

    A record sent again has a new offset but the position of the change it speaks of. A change
    without a position is no repeat of another: it is dropped only if its topic, partition and
    offset are in the log and the same, and kept otherwise.
    """
    placed = log.withColumn("_change", change_place(log))
    return placed.dropDuplicates([*spec.key_columns, "op", "_change"]).drop("_change")
