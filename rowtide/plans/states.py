"""Queries on the log: current and past rows, counts, rates, redelivered records."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.operators import rates, relations, state
from rowtide.operators.capture import to_records
from rowtide.operators.changelog import decode
from rowtide.plans import sql
from rowtide.plans import testdata as td
from rowtide.plans.registry import query
from rowtide.plans.views import open_lake
from rowtide.session import scratch
from rowtide.sources import data_files, read_table, write_by_date


def orders_log(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    return decode(td.order_records(spark, sf_dir), td.ORDERS, extras=("lsn",), **how)


def users_log(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    return decode(td.user_records(spark, sf_dir), td.USERS, extras=("lsn",), **how)


def events_log(spark: SparkSession, sf_dir: str, *extras: str, **how) -> DataFrame:
    return decode(td.event_records(spark, sf_dir), td.EVENTS, extras=("lsn", *extras), **how)


def kept_lake(spark: SparkSession, sf_dir: str, *tables: str) -> str:
    """A folder with the stored logs of some tables, as the standing job leaves them."""
    lake = scratch(spark, "lake")
    logs = {"orders": orders_log, "users": users_log}
    for name in tables:
        logs[name](spark, sf_dir).write.parquet(f"{lake}/{name}")
    return lake


@query(f"{sql.ORDERS_STATE} SELECT id, user_id, product_name, amount, created_at FROM state")
def current_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders table as its log leaves it."""
    return td.zoneless(state.current_state(orders_log(spark, sf_dir), td.ORDERS))


@query(f"{sql.USERS_STATE} SELECT id, full_name, email, created_at FROM state")
def current_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users table as its log leaves it."""
    return td.zoneless(state.current_state(users_log(spark, sf_dir), td.USERS))


@query(f"{sql.ORDERS_STATE} SELECT id, user_id, product_name, amount, created_at FROM state")
def current_orders_folded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table, out of a stored fold of the log's first years and the slice that came
    after. Only these two are read."""
    log = orders_log(spark, sf_dir)
    first = F.col("event_ts") < F.lit("1998-01-01T00:00:00Z").cast("timestamp")
    folder = scratch(spark, "fold")
    state.compacted(log.filter(first), td.ORDERS).write.parquet(f"{folder}/fold")
    log.filter(~first).write.parquet(f"{folder}/slice")
    earlier, later = (read_table(spark, f"{folder}/{part}") for part in ("fold", "slice"))
    return td.zoneless(state.current_state(state.fold(earlier, later, td.ORDERS), td.ORDERS))


@query(
    f"""{sql.ORDERS_LOG},
cut AS (SELECT max(lsn) AS place FROM log WHERE op = 'd')
SELECT id, user_id, product_name, amount, created_at FROM (
  SELECT *, row_number() OVER (PARTITION BY pk_id ORDER BY lsn DESC) AS rn
  FROM log WHERE lsn > (SELECT place FROM cut) - 1000)
WHERE rn = 1 AND NOT is_deleted"""
)
def current_after_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders table after a truncate that stands a thousand positions before the last
    delete: only what came after it is there."""
    log = orders_log(spark, sf_dir)
    last = log.filter(F.col("op") == "d").agg(F.max("lsn").alias("lsn"))
    nothing = [F.lit(None).cast(log.schema[c].dataType).alias(c) for c in td.ORDERS.columns]
    truncate = last.select(
        F.lit(None).cast("long").alias("pk_id"),
        F.lit("t").alias("op"),
        *nothing,
        F.lit(None).cast("timestamp").alias("event_ts"),
        F.lit(False).alias("is_deleted"),
        (F.col("lsn") - 1000).alias("lsn"),
    )
    return td.zoneless(state.current_state(log.unionByName(truncate), td.ORDERS))


def truncated_at_median(log: DataFrame) -> DataFrame:
    """The log with a truncate in the middle of its deletes."""
    middle = F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY lsn)").cast("long")
    place = log.filter(F.col("op") == "d").agg(middle.alias("lsn"))
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in log.schema if f.name not in ("op", "is_deleted", "lsn")]
    truncate = place.select(F.lit("t").alias("op"), F.lit(False).alias("is_deleted"), "lsn", *nothing)
    return log.unionByName(truncate)


@query(
    f"""{sql.ORDERS_LOG},
cut AS (SELECT quantile_disc(lsn, 0.5) AS place FROM log WHERE op = 'd')
SELECT id, user_id, product_name, amount, created_at FROM (
  SELECT *, row_number() OVER (PARTITION BY pk_id ORDER BY lsn DESC) AS rn
  FROM log WHERE lsn > (SELECT place FROM cut))
WHERE rn = 1 AND NOT is_deleted"""
)
def truncated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders table after a truncate in the middle of its log."""
    return td.zoneless(state.current_state(truncated_at_median(orders_log(spark, sf_dir)), td.ORDERS))


@query(f"{sql.ORDERS_STATE} SELECT id, user_id, product_name, amount, created_at FROM state")
def current_orders_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders table out of a log whose positions are a file and a number as text: the changes of a
    key stand at 8, 9 and 10, which texts would put in another order."""
    spec = replace(td.ORDERS, position="natural")
    place = F.concat(F.lit("log."), F.col("id").cast("string"), F.lit(":"), (F.col("lsn") % 10 + 8).cast("string"))
    row = F.coalesce("after", "before")
    changes = td.orders_history(spark, sf_dir).withColumns({"id": row["id"], "offset": F.col("lsn")})
    records = to_records(changes.withColumn("lsn", place), spec)
    return td.zoneless(state.current_state(decode(records, spec, extras=("position",)), spec))


AS_OF = "1999-06-01 00:00:01"


@query(
    f"""{sql.ORDERS_LOG},
last AS (SELECT *, row_number() OVER (PARTITION BY pk_id ORDER BY lsn DESC) AS rn
         FROM log WHERE event_ts <= TIMESTAMP '{AS_OF}')
SELECT id, user_id, product_name, amount, created_at FROM last WHERE rn = 1 AND NOT is_deleted"""
)
def orders_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders table as it stood at a time."""
    at = F.lit(f"{AS_OF}Z").cast("timestamp")
    return td.zoneless(state.state_as_of(orders_log(spark, sf_dir), td.ORDERS, at))


@query(f"{sql.USERS_STATE} SELECT count(*) AS n_rows FROM state")
def lake_count_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COUNT(*) of users, answered from the stored log."""
    log = read_table(spark, f"{kept_lake(spark, sf_dir, 'users')}/users")
    return state.count_rows(log, td.USERS, order_by=("lsn",))


@query(f"{sql.ORDERS_STATE} SELECT count(*) AS n_rows FROM state")
def lake_count_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COUNT(*) of orders, answered from the stored log."""
    log = read_table(spark, f"{kept_lake(spark, sf_dir, 'orders')}/orders")
    return state.count_rows(log, td.ORDERS, order_by=("lsn",))


@query(f"{sql.ORDERS_STATE} SELECT count(*) AS n_rows FROM state")
def topic_count_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same count straight from the records, of which only the key is parsed."""
    log = orders_log(spark, sf_dir, columns=["id"])
    return state.count_rows(log, td.ORDERS, order_by=("lsn",))


@query(
    f"""
SELECT o.id, o.user_id, o.product_name, o.amount, o.created_at, u.full_name
FROM ({sql.ORDERS_STATE} SELECT * FROM state) o
JOIN ({sql.USERS_STATE} SELECT * FROM state) u ON o.user_id = u.id"""
)
def lake_orders_with_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the names of their users, both answered from the stored logs."""
    lake = kept_lake(spark, sf_dir, "orders", "users")
    orders, users = (read_table(spark, f"{lake}/{name}") for name in ("orders", "users"))
    current = state.current_state(orders, td.ORDERS)
    names = state.current_state(users, td.USERS, columns=["id", "full_name"])
    return td.zoneless(relations.with_parent(current, names, "user_id", ["full_name"]))


@query(
    f"""{sql.EVENTS_LOG}
SELECT {sql.EVENTS_COLUMNS}, lsn FROM log"""
)
def dedup_redelivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log without the records that were sent twice. Changes of two kinds were sent again, at
    new offsets."""
    records = td.event_records(spark, sf_dir)
    text = F.col("value").cast("string")
    twice = text.contains('"kind":"click"') | text.contains('"op":"d"')
    sent = records.unionByName(
        records.filter(twice).withColumn("offset", F.col("offset") + 1_000_000_000)
    )
    log = decode(sent, td.EVENTS, extras=("lsn",))
    return td.zoneless(state.drop_redelivered(log, td.EVENTS))


@query(
    f"""{sql.EVENTS_LOG},
placed AS (SELECT * REPLACE (CASE WHEN op <> 'u' THEN lsn END AS lsn) FROM log)
SELECT {sql.EVENTS_COLUMNS}, lsn FROM placed
UNION ALL SELECT {sql.EVENTS_COLUMNS}, lsn FROM placed WHERE op = 'u' AND kind = 'purchase'"""
)
def dedup_without_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Redelivery where updates have no position. Records sent at new offsets are dropped by
    position; updates cannot be told from new changes and are kept each time they come."""
    records = td.event_records(spark, sf_dir)
    text = F.col("value").cast("string")
    bare = F.when(text.contains('"op":"u"'), F.regexp_replace(text, ',"lsn":[0-9]+', "")).otherwise(text)
    records = records.withColumn("value", bare.cast("binary"))
    text = F.col("value").cast("string")
    twice = text.contains('"kind":"purchase"') | text.contains('"op":"d"')
    again = records.filter(twice).withColumn("offset", F.col("offset") + 1_000_000_000)
    # The same record twice, at its own offset, is a repeat whatever it says.
    sent = records.unionByName(again).unionByName(records.filter(text.contains('"op":"u"')))
    log = decode(sent, td.EVENTS, extras=("lsn", "topic", "partition", "offset"))
    once = state.drop_redelivered(log, td.EVENTS).drop("topic", "partition", "offset")
    return td.zoneless(once)


@query(
    f"""{sql.EVENTS_LOG}
SELECT {sql.EVENTS_COLUMNS}, CAST(event_ts AS DATE) AS event_date FROM log"""
)
def partitioned_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log written with one folder per event date, and read back."""
    path = scratch(spark, "events-by-date")
    write_by_date(decode(td.event_records(spark, sf_dir), td.EVENTS), path)
    return td.zoneless(read_table(spark, path))


@query(f"{sql.ORDERS_LOG} SELECT {sql.ORDERS_COLUMNS} FROM log")
def lake_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log written to the lake in one batch, and read back."""
    path = scratch(spark, "orders")
    decode(td.order_records(spark, sf_dir), td.ORDERS).write.parquet(path)
    return td.zoneless(read_table(spark, path))


@query(f"{sql.USERS_LOG} SELECT count(*) AS n_rows FROM log")
def lake_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The data files of a table, and the rows they add up to."""
    path = scratch(spark, "users")
    decode(td.user_records(spark, sf_dir), td.USERS).write.parquet(path)
    return data_files(spark, path).agg(F.sum("n_rows").alias("n_rows"))


_RATES = f"""{sql.EVENTS_LOG},
rates AS (
SELECT date_trunc('hour', event_ts) AS window_start,
       date_trunc('hour', event_ts) + INTERVAL 1 HOUR AS window_end,
       count(*) AS n_changes, count(*) FILTER (is_deleted) AS n_deletes
FROM log GROUP BY ALL)
"""
THRESHOLD = 20


@query(f"{_RATES} SELECT * FROM rates")
def change_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes per hour."""
    return td.zoneless(rates.change_rate(events_log(spark, sf_dir)))


@query(f"{_RATES} SELECT * FROM rates WHERE n_changes > {THRESHOLD}")
def change_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours with more changes than the threshold."""
    hourly = rates.change_rate(events_log(spark, sf_dir))
    return td.zoneless(rates.rate_alerts(hourly, THRESHOLD))


@query(f"{sql.USERS_STATE} SELECT count(*) AS n_rows FROM state")
def sql_count_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-hoc SQL on the lake: a count."""
    open_lake(spark, kept_lake(spark, sf_dir, "users"), [td.USERS], prefix="lake_")
    return spark.sql("SELECT COUNT(*) AS n_rows FROM lake_users")


@query(
    f"""
SELECT o.id, o.user_id, o.product_name, o.amount, o.created_at, u.full_name
FROM ({sql.ORDERS_STATE} SELECT * FROM state) o
JOIN ({sql.USERS_STATE} SELECT * FROM state) u ON o.user_id = u.id ORDER BY o.id LIMIT 10"""
)
def sql_orders_with_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-hoc SQL on the lake: orders with their users, the first ten."""
    lake = kept_lake(spark, sf_dir, "orders", "users")
    open_lake(spark, lake, [td.ORDERS, td.USERS], prefix="lake_")
    joined = spark.sql(
        """SELECT o.*, u.full_name FROM lake_orders o JOIN lake_users u ON o.user_id = u.id
        ORDER BY o.id LIMIT 10"""
    )
    return td.zoneless(joined)


@query(f"{sql.ORDERS_LOG} SELECT op, count(*) AS n_changes FROM log GROUP BY op")
def sql_changes_by_op(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad-hoc SQL on a log: changes of each kind."""
    open_lake(spark, kept_lake(spark, sf_dir, "orders"), [td.ORDERS], prefix="lake_")
    return spark.sql("SELECT op, COUNT(*) AS n_changes FROM lake_orders_log GROUP BY op")
