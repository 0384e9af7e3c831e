"""Names for ad-hoc SQL: the log of each table, and the table as the log leaves it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rowtide.operators.rejects import log_of, rejects_of
from rowtide.operators.state import state_for_sql
from rowtide.sources.lake import read_table
from rowtide.specs import TableSpec


def create_views(log: DataFrame, spec: TableSpec, prefix: str = "") -> None:
    """Views ``<prefix><table>_log`` and ``<prefix><table>``. Both are plans, nothing is stored, and
    each statement reads only the columns it asks for."""
    log.createOrReplaceTempView(f"{prefix}{spec.name}_log")
    state_for_sql(log, spec).createOrReplaceTempView(f"{prefix}{spec.name}")


def open_lake(
    spark: SparkSession,
    tables: str,
    specs: list[TableSpec],
    *,
    fmt: str = "parquet",
    prefix: str = "",
) -> None:
    """Views on the logs that the standing job keeps below a folder, and ``<prefix><table>_rejects``
    where it keeps rejects with them."""
    for spec in specs:
        log = read_table(spark, f"{tables}/{spec.name}", fmt)
        if "part" in log.columns:
            rejects_of(log).createOrReplaceTempView(f"{prefix}{spec.name}_rejects")
            log = log_of(log, spec)
        if "batch_id" in log.columns:
            log = log.drop("batch_id")
        create_views(log, spec, prefix)
