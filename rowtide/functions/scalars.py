"""Small value functions used when rows are generated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def capitalise(word: Column) -> Column:
    """First letter upper, the rest lower."""
    return F.concat(F.upper(F.substring(word, 1, 1)), F.lower(F.substr(word, F.lit(2))))


def money(value: Column, precision: int = 10, scale: int = 2) -> Column:
    """A double rounded to ``scale`` digits, as an exact decimal."""
    return F.round(value, scale).cast(f"decimal({precision},{scale})")


def uniform(low: float, high: float, share: Column) -> Column:
    """``share`` in [0, 1) spread over [low, high)."""
    return F.lit(float(low)) + F.lit(float(high - low)) * share


def uniform_int(low: int, high: int, share: Column) -> Column:
    """``share`` in [0, 1) spread over the whole numbers low..high, both included."""
    return (F.lit(low) + F.floor(share * F.lit(high - low + 1))).cast("int")
