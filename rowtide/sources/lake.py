"""Tables in the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions import utc_date


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def read_source_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    key: str,
    partitions: int,
    bounds: tuple[int, int] | None = None,
    **options,
) -> DataFrame:
    """A table of the source database over JDBC, read in ``partitions`` ranges of a numeric key.

    The ranges divide ``bounds``, which are asked of the database where they are not given; rows
    outside them are read too, in the first and last range.
    """
    reader = spark.read.format("jdbc").options(url=url, **options)
    if bounds is None:
        ends = f"(SELECT MIN({key}) AS low, MAX({key}) AS high FROM {table}) AS ends"
        row = reader.option("dbtable", ends).load().first()
        bounds = (row[0] or 0, row[1] or 0)
    return reader.options(**range_options(table, key, partitions, bounds)).load()


def range_options(table: str, key: str, partitions: int, bounds: tuple[int, int]) -> dict[str, str]:
    """JDBC options that read a table in ranges of its key."""
    low, high = bounds
    return {
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(low),
        "upperBound": str(max(high, low + 1)),
        "numPartitions": str(partitions),
    }


def data_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The data files of a table with their row counts."""
    return (
        spark.read.format(fmt)
        .load(path)
        .select(F.col("_metadata.file_path").alias("file"))
        .groupBy("file")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def with_event_date(log: DataFrame) -> DataFrame:
    """Adds the event's date in UTC, which does not depend on the session's zone."""
    return log.withColumn("event_date", utc_date(F.col("event_ts")))


def write_by_date(
    log: DataFrame, path: str, *, fmt: str = "parquet", mode: str = "append"
) -> None:
    """Write a log with one folder per event date.

    The rebalance hint gathers a date into few files, and splits a date that is too large
    for one task instead of sending it to one.
    """
    (
        with_event_date(log)
        .hint("rebalance", "event_date")
        .write.format(fmt)
        .mode(mode)
        .partitionBy("event_date")
        .save(path)
    )
