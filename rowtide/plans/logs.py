"""Queries on decoding: raw text, edges, and whole change logs."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions import decode_decimal, encode_decimal, from_micros, from_millis
from rowtide.functions import to_micros, to_millis
from rowtide.operators.capture import to_records
from rowtide.operators.changelog import decode, drop_tombstones, raw_text as as_text
from rowtide.operators.rejects import rejects as find_rejects
from rowtide.plans import sql
from rowtide.plans import testdata as td
from rowtide.plans.registry import query
from rowtide.sources import of_table


@query(f"{sql.ORDERS_LOG} SELECT {sql.ORDERS_COLUMNS} FROM log")
def orders_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders job: records to the typed log."""
    return td.zoneless(decode(td.order_records(spark, sf_dir), td.ORDERS))


@query(f"{sql.USERS_LOG} SELECT {sql.USERS_COLUMNS} FROM log")
def users_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users job."""
    return td.zoneless(decode(td.user_records(spark, sf_dir), td.USERS))


@query(f"{sql.EVENTS_LOG} SELECT {sql.EVENTS_COLUMNS} FROM log")
def events_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third table, by its specification alone."""
    return td.zoneless(decode(td.event_records(spark, sf_dir), td.EVENTS))


@query(f'{sql.ORDERS_TOPIC} SELECT "offset", key_str, json FROM topic')
def raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and values as text."""
    return as_text(td.order_records(spark, sf_dir), "offset")


def has_product(text, product: str):
    return text.contains(f'"product_name":"{product}"')


def damaged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order records, some of them damaged as their product says: no value, cut short, an empty
    payload, or an unknown operation."""
    text = F.col("value").cast("string")
    value = (
        F.when(has_product(text, "1-URGENT"), None)
        .when(has_product(text, "2-HIGH"), F.left(text, F.lit(40)))
        .when(has_product(text, "3-MEDIUM"), '{"schema":null,"payload":null}')
        .when(has_product(text, "5-LOW"), F.regexp_replace(text, '"op":"[rc]"', '"op":"x"'))
        .otherwise(text)
    )
    return td.order_records(spark, sf_dir).withColumn("value", value.cast("binary"))


# Product, damage and whether the delete is key-only decide what becomes of a record. A
# key-only delete names no product and stays whole.
DAMAGED_SQL = f"""{sql.ORDERS_TOPIC},
damaged AS (
SELECT log.*, topic.key_str, topic.json AS whole,
       coalesce(log.product_name, '') AS product
FROM log JOIN topic ON log.lsn = topic."offset")
"""


@query(
    f"""{DAMAGED_SQL} SELECT lsn AS "offset", key_str FROM damaged WHERE product <> '1-URGENT'"""
)
def tombstone_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that have a value."""
    raw = drop_tombstones(as_text(damaged_orders(spark, sf_dir), "offset"))
    return raw.select("offset", "key_str")


@query(
    f"""{DAMAGED_SQL}
SELECT pk_id, CASE WHEN bad THEN 'x' ELSE op END AS op, CASE WHEN NOT bad THEN id END AS id,
       CASE WHEN NOT bad THEN user_id END AS user_id,
       CASE WHEN NOT bad THEN product_name END AS product_name,
       CASE WHEN NOT bad THEN amount END AS amount,
       CASE WHEN NOT bad THEN created_at END AS created_at, event_ts, is_deleted
FROM (SELECT *, product = '5-LOW' AND op IN ('r', 'c') AS bad FROM damaged)
WHERE product NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')"""
)
def bad_envelope_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of damaged records: values without an envelope are not in it."""
    return td.zoneless(decode(damaged_orders(spark, sf_dir), td.ORDERS))


@query(
    f"""{DAMAGED_SQL}
SELECT 'appdb.public.orders' AS topic, lsn AS "offset", key_str,
       CASE product WHEN '2-HIGH' THEN left(whole, 40)
                    WHEN '3-MEDIUM' THEN '{{"schema":null,"payload":null}}'
                    WHEN '5-LOW' THEN replace(whole, '"op":"' || op || '"', '"op":"x"') END AS json,
       CASE product WHEN '1-URGENT' THEN 'tombstone' WHEN '2-HIGH' THEN 'malformed'
                    WHEN '3-MEDIUM' THEN 'empty_payload' ELSE 'unknown_op' END AS reason
FROM damaged
WHERE product IN ('1-URGENT', '2-HIGH', '3-MEDIUM') OR product = '5-LOW' AND op IN ('r', 'c')"""
)
def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the log of damaged records leaves out or keeps with nulls, and why."""
    found = find_rejects(damaged_orders(spark, sf_dir), td.ORDERS)
    return found.select("topic", "offset", "key_str", "json", "reason")


# What is wrong with the records of events: it follows kind and operation, so that each reason
# that ``rejects`` does not show is here.
_SPOILT = """
CASE WHEN kind = 'click' AND op = 'c' THEN 'truncate' WHEN kind = 'view' AND op = 'c' THEN 'no_image'
     WHEN kind = 'signup' AND op = 'r' THEN 'no_key' WHEN kind = 'purchase' AND op = 'c' THEN 'bad_field'
     WHEN kind = 'purchase' AND op = 'u' THEN 'null_field' WHEN kind = 'error' AND op = 'c' THEN 'no_op'
     WHEN kind = 'error' AND op = 'u' THEN 'no_envelope' END"""


def spoilt_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = td.event_records(spark, sf_dir)
    text = F.col("value").cast("string")

    def of(kind: str, op: str) -> Column:
        return text.contains(f'"kind":"{kind}"') & text.contains(f'"op":"{op}"')

    value = (
        F.when(of("click", "c"), F.regexp_replace(text, '"after":.*,"op":"c"', '"after":null,"op":"t"'))
        .when(of("view", "c"), F.regexp_replace(text, '"after":.*,"op"', '"after":null,"op"'))
        .when(of("purchase", "c"), F.regexp_replace(text, '"user_id":[0-9]+', '"user_id":"x"'))
        .when(of("purchase", "u"), F.regexp_replace(text, r'("after":.*"user_id":)[0-9]+', "$1null"))
        .when(of("error", "c"), F.regexp_replace(text, ',"op":"c"', ""))
        .when(of("error", "u"), '{"hello":1}')
        .otherwise(text)
    )
    key = F.when(~of("signup", "r"), F.col("key"))
    return records.select(
        key.alias("key"), value.cast("binary").alias("value"), *records.columns[2:]
    )


@query(
    f"""{sql.EVENTS_LOG}
SELECT lsn AS "offset", {_SPOILT} AS reason FROM log WHERE {_SPOILT} IS NOT NULL"""
)
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The other reasons: truncates, missing images, keys, operations and envelopes, fields of
    the wrong type, and nulls where the table has none."""
    return find_rejects(spoilt_events(spark, sf_dir), td.EVENTS).select("offset", "reason")


@query(
    f"""{sql.ORDERS_LOG}
SELECT lsn AS "offset", 'decimal_overflow' AS reason FROM log WHERE amount IS NOT NULL"""
)
def reject_overflow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts that a narrower column does not hold: every record with an image of one."""
    fields = tuple(replace(f, precision=2, scale=2) if f.wire == "decimal" else f for f in td.ORDERS.fields)
    narrow = replace(td.ORDERS, fields=fields)
    return find_rejects(td.order_records(spark, sf_dir), narrow).select("offset", "reason")


@query(
    f"""{sql.ORDERS_LOG}
SELECT 'any' AS mode, lsn, amount FROM log
UNION ALL SELECT 'strict', lsn, amount FROM log WHERE coalesce(product_name, '') <> '3-MEDIUM'"""
)
def wrapped_vs_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrapped and plain values on one topic. The default reads both, strict mode the former."""
    changes = td.orders_history(spark, sf_dir)
    product = F.coalesce("after.product_name", "before.product_name")
    plain = F.coalesce(product == "3-MEDIUM", F.lit(False))
    records = to_records(changes.filter(~plain), td.ORDERS).unionByName(
        to_records(changes.filter(plain), td.ORDERS, wrapped=False)
    )
    modes = [
        decode(records, td.ORDERS, strict_wrapped=strict, extras=("lsn",)).select(
            F.lit(name).alias("mode"), "lsn", "amount"
        )
        for name, strict in (("any", False), ("strict", True))
    ]
    return modes[0].unionByName(modes[1])


@query(
    f"""{sql.ORDERS_LOG}
SELECT CASE WHEN coalesce(product_name, '') <> '3-MEDIUM' THEN pk_id END AS pk_id, id, op, lsn
FROM log"""
)
def key_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of records; a record without a key stays."""
    records = td.order_records(spark, sf_dir)
    lost = has_product(F.col("value").cast("string"), "3-MEDIUM")
    records = records.withColumn("key", F.when(~lost, F.col("key")))
    return decode(records, td.ORDERS, extras=("lsn",)).select("pk_id", "id", "op", "lsn")


@query(
    f"""{sql.USERS_LOG}
SELECT lsn, CASE WHEN op <> 'c' THEN op END AS op, CASE WHEN op <> 'c' THEN is_deleted END
       AS is_deleted
FROM log"""
)
def delete_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delete marks, null where the operation is."""
    text = F.col("value").cast("string")
    value = F.regexp_replace(text, '"op":"c"', '"op":null').cast("binary")
    records = td.user_records(spark, sf_dir).withColumn("value", value)
    return decode(records, td.USERS, extras=("lsn",)).select("lsn", "op", "is_deleted")


@query(f"{sql.ORDERS_LOG} SELECT lsn, op, id, user_id, amount FROM log")
def image_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row image each operation speaks of: after, or before for a delete."""
    log = decode(td.order_records(spark, sf_dir), td.ORDERS, extras=("lsn",))
    return log.select("lsn", "op", "id", "user_id", "amount")


@query(
    """
SELECT 'customer' AS source, c_custkey AS id, CAST(c_acctbal AS DECIMAL(20,2)) AS amount
FROM customer
UNION ALL SELECT 'orders', o_orderkey, CAST(o_totalprice AS DECIMAL(20,2)) FROM orders"""
)
def decimal_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts of either sign to bytes and back."""
    amounts = (
        td.load(spark, sf_dir, "customer")
        .select(
            F.lit("customer").alias("source"),
            F.col("c_custkey").alias("id"),
            F.col("c_acctbal").cast("decimal(20,2)").alias("amount"),
        )
        .unionByName(
            td.load(spark, sf_dir, "orders").select(
                F.lit("orders").alias("source"),
                F.col("o_orderkey").alias("id"),
                F.col("o_totalprice").cast("decimal(20,2)").alias("amount"),
            )
        )
    )
    return amounts.withColumn("amount", decode_decimal(encode_decimal(F.col("amount"))))


SCALES = (0, 2, 8, 10, 18)


def _scales_sql(kind: str) -> str:
    narrow = {
        0: "c_custkey || ''",
        **{s: f"c_custkey % 1000 || '.' || lpad(CAST(c_nationkey AS VARCHAR), {s}, '7')" for s in SCALES[1:]},
        18: "'0.' || lpad(CAST(c_custkey AS VARCHAR), 18, '7')",
    }
    wide = {
        s: "o_orderkey || '1234567890123'" + (f" || '.' || lpad(CAST(o_custkey AS VARCHAR), {s}, '3')" if s else "")
        for s in SCALES
    }
    texts, sign, digits = {
        "narrow": (narrow, "CASE WHEN c_acctbal < 0 THEN '-' ELSE '' END", 18),
        "wide": (wide, "CASE WHEN o_orderstatus = 'F' THEN '-' ELSE '' END", 38),
    }[kind]
    return ", ".join(
        f"CAST({sign} || {texts[s]} AS DECIMAL({digits},{s})) AS s{s}" for s in SCALES
    )


@query(
    f"""
SELECT 'customer' AS source, c_custkey AS id,
       {", ".join(f"CAST(s{s} AS DECIMAL(38,{s})) AS s{s}" for s in SCALES)}
FROM (SELECT c_custkey, {_scales_sql("narrow")} FROM customer)
UNION ALL SELECT 'orders', o_orderkey, {", ".join(f"s{s}" for s in SCALES)}
FROM (SELECT o_orderkey, {_scales_sql("wide")} FROM orders)"""
)
def decimal_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals of 18 and of 38 digits to bytes and back, at small and large scales."""

    def signed(negative: Column, whole: Column, fraction: Column | None) -> Column:
        parts = [whole] if fraction is None else [whole, F.lit("."), fraction]
        return F.concat(F.when(negative, "-").otherwise(""), *(p.cast("string") for p in parts))

    def filled(number: str, scale: int, digit: str) -> Column:
        return F.lpad(F.col(number).cast("string"), scale, digit)

    customers, orders = (td.load(spark, sf_dir, n) for n in ("customer", "orders"))
    narrow, wide = {}, {}
    for s in SCALES:
        key = F.col("c_custkey")
        small = signed(
            F.col("c_acctbal") < 0,
            key if s == 0 else F.lit(0) if s == 18 else key % 1000,
            None if s == 0 else filled("c_custkey" if s == 18 else "c_nationkey", s, "7"),
        )
        large = signed(
            F.col("o_orderstatus") == "F",
            F.concat(F.col("o_orderkey").cast("string"), F.lit("1234567890123")),
            filled("o_custkey", s, "3") if s else None,
        )
        for made, text, digits in ((narrow, small, 18), (wide, large, 38)):
            made[f"s{s}"] = text.cast(f"decimal({digits},{s})")
    parts = []
    for source, table, key, made, digits in (
        ("customer", customers, "c_custkey", narrow, 18),
        ("orders", orders, "o_orderkey", wide, 38),
    ):
        # Numbers, bytes and numbers again each in a projection: Spark does not take one into the next where that
        # would repeat its expressions, and computes what is common within one once, which no generator does.
        numbers = table.select(F.lit(source).alias("source"), F.col(key).alias("id"), *(c.alias(n) for n, c in made.items()))
        encoded = numbers.withColumns({f"s{s}": encode_decimal(F.col(f"s{s}"), s, digits) for s in SCALES})
        decoded = {f"s{s}": decode_decimal(F.col(f"s{s}"), 38, s) for s in SCALES}
        parts.append(encoded.withColumns(decoded))
    return parts[0].unionByName(parts[1])


@query("SELECT event_id, date_trunc('second', ts) AS created_at FROM events")
def micros_second(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Microseconds to whole seconds."""
    table = td.load(spark, sf_dir, "events")
    return td.zoneless(
        table.select("event_id", from_micros(to_micros(F.col("ts"), True)).alias("created_at"))
    )


@query("SELECT event_id, ts AS created_at FROM events")
def micros_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Microseconds to timestamps, nothing lost."""
    table = td.load(spark, sf_dir, "events")
    exact = from_micros(to_micros(F.col("ts"), True), "micro")
    return td.zoneless(table.select("event_id", exact.alias("created_at")))


@query("SELECT event_id, date_trunc('millisecond', ts) AS event_ts FROM events")
def millis_event_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Milliseconds to timestamps."""
    table = td.load(spark, sf_dir, "events")
    return td.zoneless(
        table.select("event_id", from_millis(to_millis(F.col("ts"), True)).alias("event_ts"))
    )


@query(
    f"""
SELECT topic, pk_id, op, event_ts FROM (
  SELECT 'appdb.public.orders' AS topic, pk_id, op, event_ts
  FROM ({sql.ORDERS_LOG} SELECT * FROM log)
  UNION ALL
  SELECT 'appdb.public.users', pk_id, op, event_ts FROM ({sql.USERS_LOG} SELECT * FROM log))"""
)
def topic_demux(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream of records of two tables, split by topic, each decoded by its specification."""
    records = td.order_records(spark, sf_dir).unionByName(td.user_records(spark, sf_dir))
    logs = [
        decode(of_table(records, spec), spec, extras=("topic",), columns=[]).select(
            "topic", "pk_id", "op", "event_ts"
        )
        for spec in (td.ORDERS, td.USERS)
    ]
    return td.zoneless(logs[0].unionByName(logs[1]))
