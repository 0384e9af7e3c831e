"""Queries that run as streams: records are put on a replay topic, streamed, and read back."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.operators.capture import to_records
from rowtide.operators.changelog import decode
from rowtide.operators.rejects import log_of, rejects_of
from rowtide.plans import sql
from rowtide.plans import testdata as td
from rowtide.plans.logs import DAMAGED_SQL, damaged_orders
from rowtide.plans.registry import ORACLES, query
from rowtide.plans.states import THRESHOLD, truncated_at_median
from rowtide.session import scratch
from rowtide.sources import read_replay, read_table, write_replay
from rowtide.specs import TableSpec
from rowtide.streaming import (
    append_to_table,
    arrivals,
    batch_folders,
    drop_redelivered_stream,
    fold_upserts,
    joined_logs,
    late_parents,
    once,
    orphaned,
    read_change_rate,
    read_current_state,
    start_change_alerts,
    start_change_rate,
    start_changelog,
    start_changelogs,
    start_current_state,
    start_rejects,
    state_keys,
    with_arrival,
    with_parents,
    write_batches,
)

# All that is there, in as many batches as rate limits ask for, then stop.
ONCE = {"availableNow": True}


class Replay:
    """A fresh place for a query: the topic, the tables and the checkpoints."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        base = scratch(spark, "replay")
        self.topic, self.table, self.checkpoint = (
            f"{base}/{part}" for part in ("topic", "table", "checkpoint")
        )

    def put(self, records: DataFrame) -> None:
        write_replay(records, self.topic)

    def records(self, **how) -> DataFrame:
        return read_replay(self.spark, self.topic, **how)

    def log(self, spec: TableSpec, **decode_options) -> DataFrame:
        return decode(self.records(topics=[spec.topic]), spec, **decode_options)

    def run_changelog(self, spec: TableSpec) -> None:
        """One run over all new records."""
        start_changelog(
            self.records(), spec, self.table, self.checkpoint, trigger=ONCE
        ).awaitTermination()

    def result(self, path: str | None = None) -> DataFrame:
        return td.zoneless(read_table(self.spark, path or self.table))


@query(f"{sql.ORDERS_LOG} SELECT {sql.ORDERS_COLUMNS} FROM log")
def stream_orders_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders job as a stream, from the beginning of the topic."""
    place = Replay(spark)
    place.put(td.order_records(spark, sf_dir))
    place.run_changelog(td.ORDERS)
    return place.result()


@query(f"{sql.USERS_LOG} SELECT {sql.USERS_COLUMNS} FROM log")
def stream_users_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users job, beside the orders job and on the same records."""
    place = Replay(spark)
    place.put(td.order_records(spark, sf_dir).unionByName(td.user_records(spark, sf_dir)))
    jobs = start_changelogs(
        place.records(), [td.ORDERS, td.USERS], place.table, place.checkpoint, trigger=ONCE
    )
    for job in jobs:
        job.awaitTermination()
    return place.result(f"{place.table}/{td.USERS.name}")


def first_and_later(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first event of every row, and the updates and deletes that follow."""
    first = F.col("op").isin("r", "c")
    return changes.filter(first), changes.filter(~first)


@query(f"{sql.ORDERS_LOG} SELECT {sql.ORDERS_COLUMNS} FROM log")
def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job that is stopped and started again: first the first events, then updates and
    deletes, then a run with nothing new. Nothing is lost and nothing is written twice."""
    place = Replay(spark)
    first, later = first_and_later(td.orders_history(spark, sf_dir))
    for part in (first, later, None):
        if part is not None:
            place.put(to_records(part, td.ORDERS))
        place.run_changelog(td.ORDERS)
    return place.result()


class Interrupted(Exception):
    """Stands for an executor or a store that is lost in the middle of a batch."""


@query(f"{sql.ORDERS_LOG} SELECT {sql.ORDERS_COLUMNS} FROM log")
def stream_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic ingest: the orders of some years arrive at a time, and a query takes them in at a
    fixed pace. Its second batch fails after half of it is written; started again, the query
    does that batch anew and goes on, and nothing is lost or there twice."""
    place = Replay(spark)
    at, changes = F.col("event_ts"), td.orders_history(spark, sf_dir)
    bounds = [F.lit(t).cast("timestamp_ntz") for t in ("1900-01-01", "1997-01-01", "1999-01-01", "9999-01-01")]
    keep = batch_folders(place.table)
    interruptions = [1]

    def write(batch: DataFrame, number: int) -> None:
        if number in interruptions:
            interruptions.remove(number)
            keep(batch.filter(F.col("op") == "c"), number)
            raise Interrupted(f"batch {number}")
        keep(batch, number)

    def start():
        log = place.log(td.ORDERS)
        return write_batches(log, write, place.checkpoint, trigger={"processingTime": "100 milliseconds"})

    query = None
    for first, after in zip(bounds, bounds[1:], strict=False):
        place.put(to_records(changes.filter((at >= first) & (at < after)), td.ORDERS))
        query = query or start()
        try:
            query.processAllAvailable()
        except StreamingQueryException:
            query = start()
            query.processAllAvailable()
    query.stop()
    return place.result().drop("batch_id")


@query(f"{sql.ORDERS_STATE} SELECT id, user_id, product_name, amount, created_at FROM state")
def stream_current_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current orders, kept up to date by a stream in two runs."""
    place = Replay(spark)
    for part in first_and_later(td.orders_history(spark, sf_dir)):
        place.put(to_records(part, td.ORDERS))
        log = place.log(td.ORDERS, extras=("lsn",))
        start_current_state(
            log, td.ORDERS, place.table, place.checkpoint, trigger=ONCE
        ).awaitTermination()
    return td.zoneless(read_current_state(spark, td.ORDERS, place.table))


@query(f"{sql.ORDERS_STATE} SELECT id, user_id, product_name, amount, created_at FROM state")
def stream_current_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with the first run's batches folded before the second run."""
    place = Replay(spark)
    for number, part in enumerate(first_and_later(td.orders_history(spark, sf_dir))):
        place.put(to_records(part, td.ORDERS))
        log = place.log(td.ORDERS, extras=("lsn",))
        start_current_state(
            log, td.ORDERS, place.table, place.checkpoint, trigger=ONCE
        ).awaitTermination()
        if number == 0:
            fold_upserts(spark, place.table, state_keys(td.ORDERS), upto=0)
    return td.zoneless(read_current_state(spark, td.ORDERS, place.table))


@query(ORACLES["truncated_orders"])
def stream_current_after_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current orders, kept by a stream that runs on over a truncate: first events in one run,
    updates, the truncate and deletes in another."""
    place = Replay(spark)
    log = decode(td.order_records(spark, sf_dir), td.ORDERS, extras=("lsn",))
    truncate = truncated_at_median(log).filter("op = 't'").select("lsn")
    body = F.format_string('{"payload":{"op":"t","ts_ms":0,"source":{"lsn":%d}}}', "lsn")
    changes = td.orders_history(spark, sf_dir)
    for number, part in enumerate(first_and_later(changes)):
        records = to_records(part, td.ORDERS)
        if number:
            columns = {"key": F.lit(None).cast("binary"), "value": body.cast("binary"), "topic": F.lit(td.ORDERS.topic),
                       "partition": F.lit(0), "offset": F.col("lsn"), "timestamp": F.lit(0).cast("timestamp"),
                       "timestampType": F.lit(0)}
            records = records.unionByName(truncate.withColumns(columns).select(*records.columns))
        place.put(records)
        streamed = place.log(td.ORDERS, extras=("lsn",))
        start_current_state(
            streamed, td.ORDERS, place.table, place.checkpoint, trigger=ONCE
        ).awaitTermination()
    return td.zoneless(read_current_state(spark, td.ORDERS, place.table))


@query(ORACLES["change_rate"])
def stream_change_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes per hour, counted by a stream."""
    place = Replay(spark)
    place.put(td.event_records(spark, sf_dir))
    start_change_rate(
        place.log(td.EVENTS), place.table, place.checkpoint, trigger=ONCE
    ).awaitTermination()
    return td.zoneless(read_change_rate(spark, place.table))


@query(ORACLES["change_alerts"])
def stream_change_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours with more changes than the threshold, put out by a stream with a watermark."""
    place = Replay(spark)
    place.put(td.event_records(spark, sf_dir))
    start_change_alerts(
        place.log(td.EVENTS, columns=[]),
        place.table,
        place.checkpoint,
        THRESHOLD,
        watermark="1 day",
        trigger=ONCE,
    ).awaitTermination()
    return td.zoneless(read_change_rate(spark, place.table))


@query(
    f"""{DAMAGED_SQL},
rejected AS ({ORACLES["rejects"].removeprefix(DAMAGED_SQL)})
SELECT 'log' AS part, lsn, NULL AS reason FROM damaged WHERE product NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')
UNION ALL SELECT 'rejects', "offset", reason FROM rejected"""
)
def stream_log_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log and rejects of damaged records, out of one stream that reads and parses them once."""
    place = Replay(spark)
    place.put(damaged_orders(spark, sf_dir))
    start_changelog(
        place.records(),
        td.ORDERS,
        place.table,
        place.checkpoint,
        decode_options={"extras": ("lsn",)},
        with_rejects=True,
        trigger=ONCE,
    ).awaitTermination()
    rows = read_table(spark, place.table)
    log = log_of(rows, td.ORDERS).select(
        F.lit("log").alias("part"), "lsn", F.lit(None).cast("string").alias("reason")
    )
    found = rejects_of(rows).select(F.lit("rejects"), "offset", "reason")
    return log.union(found)


@query(
    f"""{sql.EVENTS_LOG}
SELECT {sql.EVENTS_COLUMNS}, CAST(event_ts AS DATE) AS event_date FROM log"""
)
def stream_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log kept by a stream with one folder per event date."""
    place = Replay(spark)
    place.put(td.event_records(spark, sf_dir))
    start_changelog(
        place.records(), td.EVENTS, place.table, place.checkpoint, by_date=True, trigger=ONCE
    ).awaitTermination()
    return place.result().drop("batch_id")


@query(f"{sql.EVENTS_LOG} SELECT {sql.EVENTS_COLUMNS}, lsn FROM log")
def stream_dedup_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that drops the records that are sent again by a second run of the connector."""
    place = Replay(spark)
    records = td.event_records(spark, sf_dir)
    again = records.withColumn("offset", F.col("offset") + 1_000_000_000)
    for part in (records, again):
        place.put(part)
        log = place.log(td.EVENTS, extras=("lsn", "timestamp"))
        append_to_table(
            drop_redelivered_stream(log, td.EVENTS).drop("timestamp"),
            place.table,
            place.checkpoint,
            trigger=ONCE,
        ).awaitTermination()
    return place.result()


def marked_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of three runs of a connector, told by marks: all but the updates of purchases and some
    deletes; all again; and once more the updates."""
    place = Replay(spark)
    records = td.event_records(spark, sf_dir)
    text = F.col("value").cast("string")
    update, purchase = text.contains('"op":"u"'), text.contains('"kind":"purchase"')
    held = (update & ~purchase) | (text.contains('"op":"d"') & text.contains('"kind":null'))
    for part in (records.filter(~held), records, records.filter(update)):
        place.put(part)
        log = place.log(td.EVENTS, extras=("lsn",))
        append_to_table(
            with_arrival(log, td.EVENTS),
            place.table,
            place.checkpoint,
            trigger=ONCE,
            partition_by=["arrival"],
        ).awaitTermination()
    return read_table(spark, place.table)


@query(f"{sql.EVENTS_LOG} SELECT {sql.EVENTS_COLUMNS}, lsn FROM log")
def stream_dedup_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log without repeats, by a stream that remembers one position a key; changes that come late, behind
    later ones of their key, are there too."""
    rows = marked_events(spark, sf_dir)
    return td.zoneless(once(rows, td.EVENTS)).select(*td.EVENTS.log_type().fieldNames(), "lsn")


# Of the first run all is new. The second repeats the last change of each key and holds back what the first
# left out: behind, where the key's delete was there before it, or else new.
@query(
    f"""{sql.EVENTS_LOG},
runs AS (
SELECT *, op = 'u' AND kind <> 'purchase' OR op = 'd' AND kind IS NULL AS held FROM log),
first AS (SELECT pk_id, max(lsn) AS mark FROM runs WHERE NOT held GROUP BY pk_id),
second AS (
SELECT r.lsn, r.op, CASE WHEN r.lsn > f.mark THEN 'new' WHEN r.lsn = f.mark THEN 'repeat' ELSE 'behind' END AS arrival,
       held AND r.lsn < f.mark AS late FROM runs r JOIN first f USING (pk_id)),
last AS (SELECT pk_id, max(lsn) AS mark FROM log GROUP BY pk_id),
third AS (SELECT CASE WHEN l.lsn = m.mark THEN 'repeat' ELSE 'behind' END AS arrival
          FROM log l JOIN last m USING (pk_id) WHERE op = 'u'),
all_runs AS (
SELECT 'new' AS arrival FROM runs WHERE NOT held
UNION ALL SELECT arrival FROM second UNION ALL SELECT arrival FROM third
UNION ALL SELECT 'late' FROM second WHERE late)
SELECT arrival, count(*) AS n_changes FROM all_runs GROUP BY arrival"""
)
def stream_mark_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the changes of these runs arrived."""
    return arrivals(marked_events(spark, sf_dir), td.EVENTS)


def joined_topics(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders and users as both topics arrive: users of a segment four years after the others. The table of
    joined changes, and the users' log."""
    place = Replay(spark)
    created = td.users_history(spark, sf_dir).filter(F.col("op").isin("r", "c"))
    late = td.users(spark, sf_dir, F.col("c_mktsegment")).filter("c_mktsegment = 'MACHINERY'").select(F.col("id").alias("late"))
    users = created.join(late, F.col("after.id") == F.col("late"), "left").select(
        *created.columns[:3],
        F.when(F.col("late").isNull(), F.lit("1995-01-01")).otherwise("1999-01-01").cast("timestamp_ntz").alias("event_ts"),
        "lsn",
    )
    place.put(to_records(users, td.USERS))
    place.put(to_records(td.orders_history(spark, sf_dir), td.ORDERS))

    def run() -> None:
        topics = (place.records(topics=[s.topic]) for s in (td.ORDERS, td.USERS))
        rows = joined_logs(*topics, td.ORDERS, td.USERS, "user_id", ["full_name"], patience="100 days", delay="1 minute")
        append_to_table(rows, place.table, place.checkpoint, trigger=ONCE).awaitTermination()

    run()
    # Heartbeats move time on, so that orders stop waiting.
    for spec in (td.ORDERS, td.USERS):
        beat = spark.sql("SELECT CAST(NULL AS BINARY) AS key, CAST('{}' AS BINARY) AS value, 0 AS partition")
        place.put(beat.withColumns({
            "topic": F.lit(spec.topic), "offset": F.lit(2**40), "timestampType": F.lit(0),
            "timestamp": F.lit("2030-01-01").cast("timestamp"),
        }))
    run()
    users_log = decode(place.records(streaming=False, topics=[td.USERS.topic]), td.USERS)
    return read_table(spark, place.table), users_log


_JOINED = f"""{sql.ORDERS_LOG},
u AS ({sql.USERS}),
waited AS (
SELECT l.*, u.full_name, u.id AS parent, CASE WHEN u.c_mktsegment = 'MACHINERY' THEN TIMESTAMP '1999-01-01'
            ELSE TIMESTAMP '1995-01-01' END <= l.event_ts + INTERVAL 100 DAYS AS in_time
FROM log l LEFT JOIN u ON u.id = l.user_id WHERE l.op <> 'd')
"""


@query(f"{_JOINED} SELECT pk_id, lsn, op, user_id, amount, full_name FROM waited WHERE in_time")
def stream_orders_with_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of orders with the names of their users, joined while both topics arrive."""
    rows, _ = joined_topics(spark, sf_dir)
    found = with_parents(rows, td.ORDERS, "user_id")
    return found.select("pk_id", "lsn", "op", "user_id", "amount", "full_name")


@query(
    f"""{_JOINED} SELECT pk_id, lsn, user_id, NULL AS n_orphans FROM waited WHERE NOT coalesce(in_time, false)
UNION ALL SELECT NULL, NULL, parent, count(*) FROM waited WHERE NOT in_time GROUP BY parent"""
)
def stream_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of orders that were put out without a user after they had waited for it; and the users that
    came too late, with the changes that had waited."""
    rows, users = joined_topics(spark, sf_dir)
    nothing = F.lit(None).cast("long")
    orphans = orphaned(rows).select("pk_id", "lsn", "user_id", nothing.alias("n_orphans"))
    late = late_parents(rows, users, "user_id", "id")
    return orphans.unionByName(late.select(nothing.alias("pk_id"), nothing.alias("lsn"), F.col("parent").alias("user_id"), "n_orphans"))


@query(ORACLES["rejects"])
def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected records, kept by a stream."""
    place = Replay(spark)
    place.put(damaged_orders(spark, sf_dir))
    start_rejects(
        place.records(), td.ORDERS, place.table, place.checkpoint, trigger=ONCE
    ).awaitTermination()
    return place.result().select("topic", "offset", "key_str", "json", "reason")
