"""Rows with the times they held: versions of a table, and joins on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowtide.operators.changelog import AFTER_OPS, DELETE_OP
from rowtide.operators.state import TRUNCATE_OP
from rowtide.specs import TableSpec

SLOT = 1_000_000  # changes of a key that one task sorts


def versions(log: DataFrame, spec: TableSpec, *, slot: int = SLOT) -> DataFrame:
    """Every change of a row with where it holds: from ``valid_from`` to ``valid_to`` by log position, and
    from ``from_ts`` to ``to_ts`` by event time; both ends are null while nothing ends it.

    Columns: the key, ``valid_from``, ``valid_to``, ``from_ts``, ``to_ts``, ``is_deleted`` and the
    table's. Deletes are versions too, so that a change that comes late still finds its place; ``live``
    leaves them out. Truncates are versions without a key.

    By position, a change holds until the next one of its key, or a truncate. By time, the state at a
    moment is the change of the highest position among those that had happened; so a change holds until
    the earliest time of all changes of its key behind it, and of all truncates, and not at all if that
    is no later than its own. Both agree with ``state_as_of`` for every moment.

    A key of more than ``slot`` changes is cut by ranges of positions, each sorted by itself; what the
    ranges behind it add is one row a range.
    """
    return dated(placed(log, spec), spec.key_columns, slot=slot).drop("cut")


def placed(log: DataFrame, spec: TableSpec) -> DataFrame:
    """The changes that are versions, with where they begin and ``cut``, whether they are truncates."""
    keys = spec.key_columns
    truncate = F.col("op") == TRUNCATE_OP
    named = {f"pk_{k}": F.when(~truncate, F.coalesce(F.col(f"pk_{k}"), F.col(k))) for k in spec.key}
    whole = truncate | F.concat(*(F.col(k).cast("string") for k in keys)).isNotNull()
    place = F.coalesce(F.col("lsn"), F.raise_error(F.lit("a change without lsn: it cannot be ordered")).cast("long"))
    return (
        log.filter(F.col("op").isin(*AFTER_OPS, DELETE_OP, TRUNCATE_OP))
        .withColumns(named)
        .filter(whole)
        .select(*keys, place.alias("valid_from"), F.col("event_ts").alias("from_ts"), "is_deleted", truncate.alias("cut"), *spec.columns)
    )


def dated(changes: DataFrame, keys: list[str], *, slot: int = SLOT, prefer: str | None = None) -> DataFrame:
    """Adds ``valid_to`` and ``to_ts`` to changes with ``valid_from``, ``from_ts`` and ``cut``, whether they are
    truncates. A change that is there several times counts once: the one with the largest ``prefer``, a column
    without nulls, if that is given.

    Whole rows are shuffled once, by key and range; what says which keys are cut by ranges are counts.
    """
    carried = [c for c in changes.columns if c not in (*keys, "valid_from")]
    row = F.struct(*carried)
    one = F.max_by(row, prefer) if prefer else F.first(row)
    cuts = changes.filter("cut").groupBy(*keys, "valid_from").agg(one.alias("row")).select(*keys, "valid_from", "row.*")
    rows = changes.filter("NOT cut")
    # Of all changes at most one in ``slot``.
    many = rows.groupBy(*keys).count().filter(F.col("count") > slot).select(*keys, F.lit(True).alias("many"))
    range_ = F.floor(F.col("valid_from") / slot)
    # One row for each range of a key of many changes: what the ranges after it begin with.
    ranges = rows.join(F.broadcast(many), keys).groupBy(*keys, range_.alias("slot"))
    ranges = ranges.agg(F.min("valid_from").alias("first"), F.min("from_ts").alias("first_ts"))
    later = W.partitionBy(*keys).orderBy(F.desc("slot")).rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.select(*keys, "slot", F.min("first").over(later).alias("after"), F.min("first_ts").over(later).alias("after_ts"))
    rows = rows.join(F.broadcast(many), keys, "left").withColumn("slot", F.when(F.col("many"), range_).otherwise(F.lit(0).cast("long")))
    last_first = W.partitionBy(*keys, "slot").orderBy(F.desc("valid_from"), *([F.desc(prefer)] if prefer else []))
    behind = last_first.rowsBetween(W.unboundedPreceding, -1)
    once = rows.withColumn("again", F.lag("valid_from").over(last_first).eqNullSafe(F.col("valid_from"))).filter("NOT again")
    within = once.withColumns({
        "next": F.min("valid_from").over(behind), "next_ts": F.min("from_ts").over(behind)
    })
    # As many as there are truncates of the table.
    all_cuts = cuts.agg(F.coalesce(F.collect_list(F.struct("valid_from", "from_ts")), F.array())).scalar()
    joined = within.join(ranges.hint("merge"), [*keys, "slot"], "left").withColumn("cuts", all_cuts)
    ahead = F.filter("cuts", lambda c: c["valid_from"] > F.col("valid_from"))
    ended = joined.withColumns({
        "valid_to": F.least("next", "after", F.array_min(F.transform(ahead, lambda c: c["valid_from"]))),
        "to_ts": F.least("next_ts", "after_ts", F.array_min(F.transform(ahead, lambda c: c["from_ts"]))),
    })
    columns = [*keys, "valid_from", "valid_to", "from_ts", "to_ts", *(c for c in carried if c != "from_ts")]
    nothing = [F.lit(None).cast(t).alias(n) for n, t in (("valid_to", "long"), ("to_ts", "timestamp"))]
    return ended.select(*columns).unionByName(cuts.select("*", *nothing).select(*columns))


def live(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Versions that were rows of the table: no deletes, no truncates, none that never held."""
    there = ~F.col("is_deleted") & F.col(spec.key_columns[0]).isNotNull()
    return rows.filter(there & (F.col("to_ts").isNull() | (F.col("to_ts") > F.col("from_ts"))))


def at_time(rows: DataFrame, spec: TableSpec, at: Column) -> DataFrame:
    """The table at a time, out of its versions: a filter, nothing is grouped."""
    held = (F.col("from_ts") <= at) & (F.col("to_ts").isNull() | (F.col("to_ts") > at))
    return live(rows, spec).filter(held).select(*spec.columns)


def at_position(rows: DataFrame, spec: TableSpec, position: Column) -> DataFrame:
    """The table as of a log position, that change included."""
    held = (F.col("valid_from") <= position) & (F.col("valid_to").isNull() | (F.col("valid_to") > position))
    there = ~F.col("is_deleted") & F.col(spec.key_columns[0]).isNotNull()
    return rows.filter(there & held).select(*spec.columns)


def interval_join(
    points: DataFrame,
    intervals: DataFrame,
    on: list[str],
    time: str,
    start: str,
    end: str,
    *,
    resolution: str = "1 hour",
) -> DataFrame:
    """Points with the intervals that hold them: equal in ``on``, and ``start <= time < end``; an end that
    is null is open.

    An equal join: an interval goes to the one or two blocks of time that it touches among blocks about as
    long as itself, and a point to its block of each length that there is. So no pair meets twice, and long
    intervals meet few points outside them. Open intervals end at the last point. A value of ``on`` that
    very many rows share is spread over its blocks, and Spark's skew join splits what remains. Neither side
    is broadcast: Spark's estimate is that of the files behind them, before the rows are dealt to blocks. Both
    sides keep their columns; those of ``on`` are there once. Null times and null values join nothing.
    """
    micros = F.expr(f"unix_micros(TIMESTAMP '1970-01-01 00:00:00Z' + INTERVAL {resolution})")
    unit = points.sparkSession.range(1).select(micros.alias("n")).first().n
    last = points.agg(F.max(F.unix_micros(time))).first()[0]
    if last is None:
        last = 0
    from_, to = F.unix_micros(start), F.least(F.coalesce(F.unix_micros(end), F.lit(last + 1)), F.lit(last + 1))
    sized = intervals.filter(F.col(start).isNotNull()).withColumns({"_from": from_, "_to": to}).filter("_from < _to")
    length = (F.col("_to") - F.col("_from")) / F.lit(float(unit))
    level = F.when(length <= 1, 0).otherwise(F.ceil(F.log2(length))).cast("int")
    sized = sized.withColumn("_level", level)
    # At most 64 of them, whatever the intervals.
    levels = sorted(r[0] for r in sized.select("_level").distinct().collect())
    size = lambda column: F.lit(unit) * F.pow(F.lit(2.0), column).cast("long")
    block = lambda moment, column: F.floor(moment / size(column))
    blocks = F.array_distinct(F.array(block(F.col("_from"), F.col("_level")), block(F.col("_to") - 1, F.col("_level"))))
    dealt = sized.select("*", F.explode(blocks).alias("_block"))
    at = F.unix_micros(time)
    asked = points.filter(F.col(time).isNotNull()).withColumn("_level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")))
    asked = asked.withColumn("_block", block(at, F.col("_level")))
    clash = set(points.columns) & set(intervals.columns) - set(on)
    if clash:
        raise ValueError(f"points and intervals both have {sorted(clash)}")
    found = asked.join(dealt.hint("merge"), [*on, "_level", "_block"])
    held = (F.unix_micros(time) >= F.col("_from")) & (F.unix_micros(time) < F.col("_to"))
    return found.filter(held).select(*points.columns, *(c for c in intervals.columns if c not in on))
