"""Epoch numbers and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two readings of a microsecond column.
PRECISIONS = ("second", "micro")


def from_micros(micros: Column, precision: str = "second") -> Column:
    """Microseconds since the epoch to a timestamp.

    ``"second"`` cuts the sub-second part toward zero, ``"micro"`` keeps it.
    """
    if precision not in PRECISIONS:
        raise ValueError(f"precision is one of {PRECISIONS}")
    if precision == "micro":
        return F.timestamp_micros(micros)
    return F.timestamp_seconds(F.call_function("div", micros, F.lit(1_000_000)))


def from_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def to_micros(ts: Column, zoneless: bool = False) -> Column:
    """Timestamp to microseconds since the epoch.

    A zone-less timestamp is taken as UTC. Its distance from the epoch is an exact interval, so
    the session zone plays no part.
    """
    if not zoneless:
        return F.unix_micros(ts)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    seconds = (ts - epoch).cast("interval second").cast("decimal(18,6)")
    return (seconds * F.lit(1_000_000)).cast("bigint")


def utc_date(ts: Column) -> Column:
    """The date of an instant in UTC, whatever the session's zone."""
    days = F.floor(F.unix_seconds(ts) / F.lit(86_400)).cast("int")
    return F.date_from_unix_date(days)


def zoneless_utc(ts: Column) -> Column:
    """An instant as the zone-less timestamp that clocks in UTC show."""
    seconds = F.unix_micros(ts).cast("decimal(24,0)") / F.lit(1_000_000)
    since = F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since


def to_millis(ts: Column, zoneless: bool = False) -> Column:
    """Timestamp to milliseconds since the epoch; what is below them is cut off downward."""
    if not zoneless:
        return F.unix_millis(ts)
    micros = to_micros(ts, True)
    return F.call_function("div", micros - F.pmod(micros, F.lit(1000)), F.lit(1000))
