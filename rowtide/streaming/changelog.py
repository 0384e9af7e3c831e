"""Streams of change records into change logs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowtide.operators.changelog import decode
from rowtide.operators.rejects import judged, rejects
from rowtide.session import STATE_STORE_CONF, defaults
from rowtide.sources.lake import with_event_date
from rowtide.sources.records import of_table
from rowtide.specs import TableSpec
from rowtide.streaming.state import write_batches


def append_to_table(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    *,
    fmt: str = "parquet",
    trigger: dict | None = None,
    partition_by: list[str] | None = None,
    files_per_batch: int | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start appending a stream to a table.

    The checkpoint keeps the progress: a restart goes on where the last run ended, without
    loss or repeats. ``trigger`` takes the arguments of ``DataStreamWriter.trigger``; without it
    batches follow each other at once. ``files_per_batch`` holds down the number of files,
    and with it the number of tasks that decode.
    """
    if files_per_batch is not None:
        rows = rows.coalesce(files_per_batch)
    writer = (
        rows.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    if trigger:
        writer = writer.trigger(**trigger)
    # Without effect on a log, which keeps no state; for streams that drop repeats.
    with defaults(rows.sparkSession, STATE_STORE_CONF):
        return writer.start()


def start_changelog(
    records: DataFrame,
    spec: TableSpec,
    path: str,
    checkpoint: str,
    *,
    decode_options: dict | None = None,
    by_date: bool = False,
    with_rejects: bool = False,
    **sink,
) -> StreamingQuery:
    """Start keeping the change log of one table, with one folder per event date if asked for.

    By date, each batch is gathered by date, so that it adds a file or a few to a date and not one
    from every task (``batches_by_date``). ``with_rejects`` keeps every record, the rejected ones too, in one table with a folder for each part
    (``log_of`` and ``rejects_of`` read it); the topic is still read and parsed once.
    """
    own = of_table(records, spec)
    options = decode_options or {}
    log = judged(own, spec, **options) if with_rejects else decode(own, spec, **options)
    parts = ["part"] if with_rejects else []
    if by_date:
        write = batches_by_date(path, [*parts, "event_date"], fmt=sink.pop("fmt", "parquet"))
        return write_batches(with_event_date(log), write, checkpoint, **sink)
    if parts:
        sink["partition_by"] = parts
    return append_to_table(log, path, checkpoint, **sink)


def batches_by_date(
    path: str, partition_by: list[str], *, fmt: str = "parquet"
) -> Callable[[DataFrame, int], None]:
    """Writes each batch to folders, the last of them for its number, replacing an earlier attempt.

    Rows are gathered by the folders' columns, and by measured size: a date with very many rows, as
    in the first batch over an old topic, is split over as many tasks as it fills, and so are the records
    without a date, which are broken ones and tombstones of all times. A Delta table is one table, and an
    attempt that was committed before is passed over by its number.
    """
    adaptive = "spark.sql.adaptive.enabled"  # off in a stream's own session, which keeps no state here

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        usual = session.conf.get(adaptive)
        session.conf.set(adaptive, "true")
        try:
            rows = batch.withColumn("batch_id", F.lit(batch_id).cast("long")).hint("rebalance", *partition_by)
            if fmt == "delta":
                writer = rows.write.format(fmt).mode("append").partitionBy(*partition_by)
                writer.option("txnAppId", path).option("txnVersion", batch_id).save(path)
            else:
                writer = rows.write.format(fmt).mode("overwrite").partitionBy(*partition_by, "batch_id")
                writer.option("partitionOverwriteMode", "dynamic").save(path)
        finally:
            session.conf.set(adaptive, usual)

    return write


def start_changelogs(
    records: DataFrame | Callable[[TableSpec], DataFrame],
    specs: list[TableSpec],
    path: str,
    checkpoint: str,
    **options,
) -> list[StreamingQuery]:
    """Start one log per table, below ``path`` by table name.

    Each table has its own query and checkpoint, so tables advance independently. ``records``
    holds the records of all tables or gives those of one; on a broker the latter lets each
    query read its own topic only.
    """
    return [
        start_changelog(
            records(spec) if callable(records) else records,
            spec,
            f"{path}/{spec.name}",
            f"{checkpoint}/{spec.name}",
            **options,
        )
        for spec in specs
    ]


def start_rejects(
    records: DataFrame,
    spec: TableSpec,
    path: str,
    checkpoint: str,
    *,
    strict_wrapped: bool = False,
    **sink,
) -> StreamingQuery:
    """Start keeping the records that do not reach the log intact, by a reading of their own.

    ``start_changelog(with_rejects=True)`` keeps them and the log with one reading.
    """
    rows = rejects(of_table(records, spec), spec, strict_wrapped=strict_wrapped)
    return append_to_table(rows, path, checkpoint, **sink)


def await_any(spark: SparkSession, timeout: float | None = None) -> None:
    """Wait until any query of the session ends; its failure is raised here."""
    if timeout is None:
        spark.streams.awaitAnyTermination()
    else:
        spark.streams.awaitAnyTermination(timeout)
