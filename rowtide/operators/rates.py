"""How many changes a table sees per time window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def change_rate(log: DataFrame, every: str = "1 hour", watermark: str | None = None) -> DataFrame:
    """Changes per window of the event time. Counts are summed up before the shuffle; on a
    stream a watermark lets closed windows leave the state."""
    if watermark is not None:
        log = log.withWatermark("event_ts", watermark)
    return (
        log.groupBy(F.window("event_ts", every).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("n_changes"),
            F.count_if(F.col("is_deleted")).alias("n_deletes"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "n_changes",
            "n_deletes",
        )
    )


def rate_alerts(rates: DataFrame, threshold: int) -> DataFrame:
    """Windows with more changes than the threshold."""
    return rates.filter(F.col("n_changes") > threshold)
