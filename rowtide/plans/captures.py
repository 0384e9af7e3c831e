"""Queries on capture: snapshots, changes between versions, topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowtide.operators import capture
from rowtide.operators.changelog import decode
from rowtide.plans import sql
from rowtide.plans import testdata as td
from rowtide.plans.registry import query
from rowtide.sources import in_topic_order, peek, topics


@query(
    f"""
SELECT id AS pk_id, 'r' AS op, id, full_name, email, created_at,
       TIMESTAMP '2024-02-01 00:00:00' AS event_ts, false AS is_deleted
FROM ({sql.USERS})"""
)
def snapshot_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole table as snapshot reads, written as records and decoded."""
    at = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    events = capture.snapshot_events(td.users(spark, sf_dir), td.USERS, at, F.lit(0))
    return td.zoneless(decode(capture.to_records(events, td.USERS), td.USERS))


def two_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders before the pending ones came in, and after: the finished low ones are purged and
    the urgent ones cost one more."""
    status, product = F.col("o_orderstatus"), F.col("product_name")
    table = td.orders(spark, sf_dir, status)
    dearer = (F.col("amount") + F.lit(1).cast("decimal(10,2)")).cast("decimal(10,2)")
    new = table.filter(~((status == "F") & (product == "5-LOW"))).withColumn(
        "amount", F.when(product == "1-URGENT", dearer).otherwise(F.col("amount"))
    )
    return table.filter(status != "P").drop("o_orderstatus"), new.drop("o_orderstatus")


_SIDES = ", ".join(
    f"{side}.{c} AS {side}_{c}" for side in ("old", "new") for c in td.ORDERS.columns[1:]
)


@query(
    f"""
WITH t AS ({sql.ORDERS}),
old AS (SELECT * FROM t WHERE o_orderstatus <> 'P'),
new AS (SELECT * REPLACE (CAST(amount + CASE product_name WHEN '1-URGENT' THEN 1 ELSE 0 END
                               AS DECIMAL(10,2)) AS amount)
        FROM t WHERE NOT (o_orderstatus = 'F' AND product_name = '5-LOW'))
SELECT CASE WHEN old.id IS NULL THEN 'c' WHEN new.id IS NULL THEN 'd' ELSE 'u' END AS op,
       coalesce(new.id, old.id) AS id, {_SIDES}
FROM old FULL JOIN new ON old.id = new.id
WHERE old.amount IS DISTINCT FROM new.amount"""
)
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes between two versions of a table."""
    old, new = two_versions(spark, sf_dir)
    return shown_changes(capture.diff_events(old, new, td.ORDERS, F.current_timestamp(), F.lit(1)))


def shown_changes(changes: DataFrame) -> DataFrame:
    return changes.select(
        "op",
        F.coalesce("after.id", "before.id").alias("id"),
        *(
            F.col(f"{side}.{c}").alias(f"{name}_{c}")
            for side, name in (("before", "old"), ("after", "new"))
            for c in td.ORDERS.columns[1:]
        ),
    )


@query(
    f"""
WITH t AS ({sql.ORDERS}),
old AS (SELECT id FROM t UNION ALL SELECT id FROM t WHERE product_name = '2-HIGH')
SELECT id, 'old' AS version, count(*) AS n_rows FROM old GROUP BY id HAVING count(*) > 1
UNION ALL SELECT NULL, 'new', count(*) FROM t WHERE product_name = '5-LOW'"""
)
def diff_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that a comparison of two versions leaves out: some stand twice in the old version, and
    some are missing in the new one."""
    table = td.orders(spark, sf_dir)
    product = F.col("product_name")
    old = table.unionByName(table.filter(product == "2-HIGH"))
    new = table.withColumn("id", F.when(product != "5-LOW", F.col("id")))
    return capture.diff_repeats(old, new, td.ORDERS)


@query("SELECT count(*) AS n_records, count(*) AS n_offsets FROM customer")
def snapshot_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a snapshot, whose changes share one position, and their different offsets."""
    at = F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    events = capture.snapshot_events(td.users(spark, sf_dir), td.USERS, at, F.lit(0))
    records = capture.to_records(capture.with_offsets(events), td.USERS)
    return records.agg(
        F.count(F.lit(1)).alias("n_records"), F.count_distinct("offset").alias("n_offsets")
    )


@query(
    f"""
SELECT id AS pk_id, 'c' AS op, id, full_name, email, created_at, created_at AS event_ts,
       false AS is_deleted
FROM ({sql.USERS})"""
)
def insert_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserted rows as create events."""
    events = capture.insert_events(
        td.users(spark, sf_dir), td.USERS, F.col("created_at"), F.col("id")
    )
    return td.zoneless(decode(capture.to_records(events, td.USERS), td.USERS))


EMAIL = "customer#000000007@example.com"


@query(
    f"""
SELECT 'u' AS op, id, full_name AS old_name, full_name || ' Updated' AS new_name, email
FROM ({sql.USERS}) WHERE email = '{EMAIL}'"""
)
def update_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An update of the user with an email."""
    events = capture.update_events(
        td.users(spark, sf_dir),
        td.USERS,
        F.col("email") == EMAIL,
        {"full_name": F.concat("full_name", F.lit(" Updated"))},
        F.col("created_at"),
        F.col("id"),
    )
    return events.select(
        "op",
        "after.id",
        F.col("before.full_name").alias("old_name"),
        F.col("after.full_name").alias("new_name"),
        "after.email",
    )


@query(
    f"""
SELECT id AS pk_id, 'd' AS op, id, full_name, email, created_at, created_at AS event_ts,
       true AS is_deleted
FROM ({sql.USERS}) WHERE email = '{EMAIL}'"""
)
def delete_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delete of the user with an email, as it stands in the log."""
    events = capture.delete_events(
        td.users(spark, sf_dir),
        td.USERS,
        F.col("email") == EMAIL,
        F.col("created_at"),
        F.col("id"),
    )
    return td.zoneless(decode(capture.to_records(events, td.USERS), td.USERS))


@query(
    f"""
SELECT pk_id, CAST(2 AS BIGINT) AS n_records, CAST(1 AS BIGINT) AS n_tombstones
FROM ({sql.ORDERS_LOG} SELECT * FROM log) WHERE op = 'd'"""
)
def delete_tombstones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deletes with tombstones on: each is followed by a record without a value."""
    deletes = td.orders_history(spark, sf_dir).filter(F.col("op") == "d")
    records = capture.to_records(deletes, td.ORDERS, tombstones=True)
    key = F.from_json(F.col("key").cast("string"), "payload struct<id:bigint>")
    return records.groupBy(key["payload"]["id"].alias("pk_id")).agg(
        F.count(F.lit(1)).alias("n_records"),
        F.count_if(F.col("value").isNull()).alias("n_tombstones"),
    )


def tagged_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of three tables, which lie in three schemas."""
    tables = (
        ("public", "orders", td.orders_history),
        ("publicx", "users", td.users_history),
        ("audit", "events", td.events_history),
    )
    parts = [
        changes(spark, sf_dir).select(F.lit(s).alias("schema"), F.lit(t).alias("table"), "lsn")
        for s, t, changes in tables
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_COUNTS = f"""
counts AS (
SELECT 'public' AS schema, 'orders' AS "table", count(*) AS n_changes
FROM ({sql.ORDERS_LOG} SELECT * FROM log)
UNION ALL SELECT 'publicx', 'users', count(*) FROM ({sql.USERS_LOG} SELECT * FROM log)
UNION ALL SELECT 'audit', 'events', count(*) FROM ({sql.EVENTS_LOG} SELECT * FROM log))
"""


@query(
    f"""WITH {_COUNTS}
SELECT schema, "table", n_changes,
       regexp_full_match(schema || '.' || "table", 'public.*') AS by_table,
       regexp_full_match(schema, 'public')
       AND regexp_full_match(schema || '.' || "table", 'public.*') AS by_both
FROM counts"""
)
def include_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which tables the include lists take: the table list alone, and with the schema list."""
    names = F.col("schema"), F.col("table")
    return (
        tagged_changes(spark, sf_dir)
        .groupBy("schema", "table")
        .agg(F.count(F.lit(1)).alias("n_changes"))
        .withColumn("by_table", capture.included(*names, table_list="public.*"))
        .withColumn("by_both", capture.included(*names, "public", "public.*"))
    )


@query(
    f"""WITH {_COUNTS}
SELECT 'appdb.' || schema || '.' || "table" AS topic, n_changes FROM counts"""
)
def topic_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of changes each topic gets."""
    topic = capture.topic_name(F.lit("appdb"), F.col("schema"), F.col("table"))
    return (
        tagged_changes(spark, sf_dir)
        .groupBy(topic.alias("topic"))
        .agg(F.count(F.lit(1)).alias("n_changes"))
    )


@query(
    """
SELECT 'appdb.public.orders' AS topic FROM orders
UNION SELECT 'appdb.public.users' FROM customer"""
)
def topic_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics that hold records."""
    records = td.order_records(spark, sf_dir).unionByName(td.user_records(spark, sf_dir))
    return topics(records)


@query(
    f"""{sql.ORDERS_TOPIC}
SELECT 'appdb.public.orders' AS topic, 0 AS partition, "offset", key_str, json
FROM topic ORDER BY "offset" LIMIT 5"""
)
def topic_peek(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five messages of a topic."""
    records = td.order_records(spark, sf_dir).unionByName(td.user_records(spark, sf_dir))
    return peek(records, td.ORDERS.topic, 5)


@query(
    f"""
SELECT topic, count(*) AS n_records, min(lsn) AS first_offset, max(lsn) AS last_offset,
       CAST(0 AS BIGINT) AS n_overlaps
FROM (SELECT 'appdb.public.orders' AS topic, lsn FROM ({sql.ORDERS_LOG} SELECT * FROM log)
      UNION ALL
      SELECT 'appdb.public.users', lsn FROM ({sql.USERS_LOG} SELECT * FROM log))
GROUP BY topic"""
)
def topic_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records put in topic order over many tasks: size and ends of each topic, and how many
    tasks begin before the one ahead of them ends, which none may."""
    records = td.order_records(spark, sf_dir).unionByName(td.user_records(spark, sf_dir))
    runs = (
        in_topic_order(records)
        .groupBy("topic", F.spark_partition_id().alias("task"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("offset").alias("low"),
            F.max("offset").alias("high"),
        )
    )
    ahead = F.lag("high").over(W.partitionBy("topic").orderBy("task"))
    return (
        runs.withColumn("overlaps", F.col("low") <= ahead)
        .groupBy("topic")
        .agg(
            F.sum("n").alias("n_records"),
            F.min("low").alias("first_offset"),
            F.max("high").alias("last_offset"),
            F.count_if("overlaps").alias("n_overlaps"),
        )
    )
