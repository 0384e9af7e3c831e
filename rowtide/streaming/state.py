"""Streams that keep state: current rows, change rates, redelivered records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rowtide.operators.rates import change_rate, rate_alerts
from rowtide.operators.state import after_truncate, change_place, last_changes
from rowtide.session import STATE_STORE_CONF, defaults
from rowtide.specs import TableSpec


def write_batches(
    rows: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start handing each batch of updates and its number to ``write``.

    A batch that fails is handed over again with the same number and rows after a restart, so
    ``write`` has to replace what it wrote under that number before.
    """
    writer = (
        rows.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )
    if trigger:
        writer = writer.trigger(**trigger)
    with defaults(rows.sparkSession, STATE_STORE_CONF):
        return writer.start()


def batch_folders(
    path: str, *, fmt: str = "parquet", files_per_batch: int | None = None
) -> Callable[[DataFrame, int], None]:
    """Writes each batch under its number, replacing an earlier attempt.

    As files a batch is a folder. A Delta table is one table with a column ``batch_id``, and an
    attempt that was committed before is passed over by its number.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if files_per_batch is not None:
            batch = batch.repartition(files_per_batch)
        if fmt == "delta":
            numbered = batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
            writer = numbered.write.format(fmt).mode("append")
            writer.option("txnAppId", path).option("txnVersion", batch_id).save(path)
        else:
            batch.write.format(fmt).mode("overwrite").save(f"{path}/batch_id={batch_id}")

    return write


def start_upserts(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    *,
    fmt: str = "parquet",
    trigger: dict | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start writing the keys that an aggregate changes, under the number of their batch.

    Only changed keys are written. The state has as many partitions as the session shuffles to;
    ``files_per_batch`` gathers what they put out into fewer files. ``fold_upserts`` keeps what
    readers have to reduce from growing with the number of batches.
    """
    write = batch_folders(path, fmt=fmt, files_per_batch=files_per_batch)
    return write_batches(rows, write, checkpoint, trigger=trigger)


def _folded(path: str) -> str:
    return f"{path.rstrip('/')}-folded"


def _last_fold(spark: SparkSession, path: str) -> int | None:
    """The number of the last batch in the newest fold, by the names of the folders."""
    place = spark._jvm.org.apache.hadoop.fs.Path(_folded(path))
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(place):
        return None
    names = [str(f.getPath().getName()) for f in files.listStatus(place)]
    done = [n for n in names if files.exists(_marker(spark, f"{_folded(path)}/{n}"))]
    return max((int(n.removeprefix("upto=")) for n in done), default=None)


def _marker(spark: SparkSession, folder: str):
    return spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")


def _reduced(written: DataFrame, keys: list[str]) -> DataFrame:
    others = [c for c in written.columns if c not in keys]
    last = F.max_by(F.struct(*others), "batch_id")
    return written.groupBy(*keys).agg(last.alias("row")).select(*keys, "row.*")


def _upserts(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    """The newest fold and the batches after it."""
    batches = spark.read.format(fmt).load(path)
    batches = batches.withColumn("batch_id", F.col("batch_id").cast("long"))
    upto = None if fmt == "delta" else _last_fold(spark, path)
    if upto is None:
        return batches
    fold = spark.read.format(fmt).load(f"{_folded(path)}/upto={upto}")
    return batches.filter(F.col("batch_id") > upto).unionByName(fold)


def read_upserts(
    spark: SparkSession, path: str, keys: list[str], fmt: str = "parquet"
) -> DataFrame:
    """The last written row of every key. Batches before the newest fold are not read."""
    return _reduced(_upserts(spark, path, fmt), keys).drop("batch_id")


def fold_upserts(
    spark: SparkSession, path: str, keys: list[str], *, upto: int, fmt: str = "parquet"
) -> None:
    """Reduces the batches up to number ``upto``, and the last fold, to one row per key.

    The stream may go on meanwhile; ``upto`` has to be a batch it has committed. The batches
    themselves stay until they are removed by other means; they are not read any more.
    """
    if fmt == "delta":
        raise ValueError("a Delta table is one table; compact it by Delta's own means")
    rows = _upserts(spark, path, fmt).filter(F.col("batch_id") <= upto)
    _reduced(rows, keys).write.format(fmt).mode("overwrite").save(f"{_folded(path)}/upto={upto}")


def start_current_state(
    log: DataFrame, spec: TableSpec, path: str, checkpoint: str, **sink
) -> StreamingQuery:
    """Start keeping the current rows of a table.

    The state is one row per key, and one for the last truncate. Batches touch only the keys that
    changed; the log is never read again. A truncate takes no rows out of the state, where they
    may still be told from changes that come late; readers leave out what stands before it.
    """
    return start_upserts(last_changes(log, spec, truncates=True), path, checkpoint, **sink)


def read_current_state(spark: SparkSession, spec: TableSpec, path: str) -> DataFrame:
    """The table as the stream has it: its last changes, without deleted rows and those that a
    truncate took."""
    rows = after_truncate(read_upserts(spark, path, state_keys(spec)))
    return rows.filter(~F.col("is_deleted")).select(*spec.columns)


def state_keys(spec: TableSpec) -> list[str]:
    """The key that the batches of ``start_current_state`` are written, read and folded by."""
    return [*spec.key_columns, "truncates"]


def start_change_rate(
    log: DataFrame,
    path: str,
    checkpoint: str,
    *,
    every: str = "1 hour",
    watermark: str | None = None,
    **sink,
) -> StreamingQuery:
    """Start counting changes per window. Without a watermark no late change is lost and every
    window stays in the state; with one, windows older than it are closed, and ``Progress``
    counts the changes that came too late for theirs."""
    return start_upserts(change_rate(log, every, watermark), path, checkpoint, **sink)


def read_change_rate(spark: SparkSession, path: str) -> DataFrame:
    return read_upserts(spark, path, ["window_start", "window_end"])


def start_change_alerts(
    log: DataFrame,
    path: str,
    checkpoint: str,
    threshold: int,
    *,
    every: str = "1 hour",
    watermark: str | None = None,
    **sink,
) -> StreamingQuery:
    """Start putting out windows with more changes than the threshold, as soon as they have them
    and again as they grow. ``read_change_rate`` gives the last count of each. A watermark closes
    windows as in ``start_change_rate``."""
    alerts = rate_alerts(change_rate(log, every, watermark), threshold)
    return start_upserts(alerts, path, checkpoint, **sink)


def drop_redelivered_stream(log: DataFrame, spec: TableSpec, horizon: str | None = None) -> DataFrame:
    """Drop records that were sent again, on a stream that carries ``lsn`` and the broker's
    ``timestamp``, and ``partition`` and ``offset`` if there are changes without a position.

    A change without a position is a repeat only of the same record. Without a horizon every
    change is remembered. With one, a change is forgotten that much arrival time after it; the
    time is the broker's, so late events are not taken for old ones. A record that arrives later
    than the horizon is dropped; ``Progress`` counts such records.
    """
    placed = log.withColumn("_change", change_place(log))
    keys = [*spec.key_columns, "op", "_change"]
    if horizon is None:
        return placed.dropDuplicates(keys).drop("_change")
    late = placed.withWatermark("timestamp", horizon)
    return late.dropDuplicatesWithinWatermark(keys).drop("_change")
