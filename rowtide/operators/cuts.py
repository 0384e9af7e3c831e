"""States of several tables as of one position that all their logs have reached."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.operators.state import current_state
from rowtide.specs import TableSpec


def progress_marks(logs: dict[str, DataFrame], heartbeats: DataFrame | None = None) -> DataFrame:
    """How far each log has come: ``name``, ``reached``, ``n_changes``.

    ``heartbeats`` (``name``, ``lsn``) are positions that the source is known to have passed without a change
    of the table; without them a table that rests holds the others back.
    """
    marks = [
        log.agg(F.max("lsn").alias("reached"), F.count(F.lit(1)).alias("n_changes")).select(F.lit(n).alias("name"), "*")
        for n, log in logs.items()
    ]
    if heartbeats is not None:
        marks.append(heartbeats.select("name", F.col("lsn").alias("reached"), F.lit(0).cast("long").alias("n_changes")))
    rows = reduce(DataFrame.unionByName, marks)
    return rows.groupBy("name").agg(F.max("reached").alias("reached"), F.sum("n_changes").alias("n_changes"))


def common_position(marks: DataFrame) -> DataFrame:
    """The largest position that every log has reached: one row, ``lsn``, null if one has nothing yet."""
    some = F.count_if(F.col("reached").isNull()) == 0
    return marks.agg(F.when(some, F.min("reached")).alias("lsn"))


def consistent_states(
    logs: dict[str, DataFrame], specs: list[TableSpec], heartbeats: DataFrame | None = None
) -> dict[str, DataFrame]:
    """The tables as of the last position that all logs have reached, so that what one table says of another
    is there. Positions must be those of one source, shared by its tables. While a log has neither changes
    nor heartbeats, all tables are empty.

    The position is one value, looked up by a scan of the positions alone; it reaches the logs' scans as a
    filter.
    """
    cut = common_position(progress_marks(logs, heartbeats)).scalar()
    return {s.name: current_state(logs[s.name].filter(F.col("lsn") <= cut), s) for s in specs}
