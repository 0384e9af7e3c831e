"""The given tables as source tables, and the histories of change that queries run on.

Every history covers its whole table. Which rows change, and how, follows the row's own
attributes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.functions import zoneless_utc
from rowtide.operators.capture import changed_row, key_only, no_row, row_of, to_records
from rowtide.specs import Field, TableSpec

# The tables have 64-bit keys, so their captured form has them too.
ORDERS = TableSpec(
    "orders",
    (
        Field("id", "long", unique=True),
        Field("user_id", "long"),
        Field("product_name", "text"),
        Field("amount", "decimal"),
        Field("created_at", "timestamp"),
    ),
)
USERS = TableSpec(
    "users",
    (
        Field("id", "long", unique=True),
        Field("full_name", "text"),
        Field("email", "text", unique=True),
        Field("created_at", "timestamp"),
    ),
)
EVENTS = TableSpec(
    "events",
    (
        Field("id", "long", unique=True),
        Field("user_id", "long"),
        Field("kind", "text"),
        Field("value", "double"),
        Field("props", "text"),
        Field("created_at", "timestamp"),
    ),
)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("product_name"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("amount"),
        F.col("o_orderdate").alias("created_at"),
        *extra,
    )


def users(spark: SparkSession, sf_dir: str, *extra: Column) -> DataFrame:
    epoch = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return load(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("full_name"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        (epoch + F.make_dt_interval(secs=F.col("c_custkey"))).alias("created_at"),
        *extra,
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        "user_id",
        F.col("event_type").alias("kind"),
        "value",
        "props",
        F.col("ts").alias("created_at"),
    )


def history(
    table: DataFrame,
    spec: TableSpec,
    *,
    existed: Column,
    updated: Column,
    values: dict[str, Column],
    deleted: Column,
    keyed: Column,
) -> DataFrame:
    """One to three changes per row: read or created, perhaps updated a second later, perhaps
    deleted after that, with a full or a key-only row image. One pass over the table."""
    first, none = row_of(spec), no_row(spec)
    second, stub = changed_row(table, spec, values), key_only(table, spec)
    last = F.when(keyed, stub).when(updated, second).otherwise(first)

    def change(step: int, op: Column, before: Column, after: Column) -> Column:
        return F.struct(
            op.alias("op"),
            before.alias("before"),
            after.alias("after"),
            (F.col("created_at") + F.expr(f"INTERVAL {step} SECOND")).alias("event_ts"),
            (F.col("id") * 10 + step).alias("lsn"),
        )

    steps = F.array(
        change(0, F.when(existed, "r").otherwise("c"), none, first),
        F.when(updated, change(1, F.lit("u"), first, second)),
        F.when(deleted, change(2, F.lit("d"), last, none)),
    )
    changes = table.select(F.explode(steps).alias("change"))
    return changes.filter(F.col("change").isNotNull()).select("change.*")


def orders_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, high = F.col("product_name") == "5-LOW", F.col("product_name") == "2-HIGH"
    urgent, pending = F.col("product_name") == "1-URGENT", F.col("o_orderstatus") == "P"
    return history(
        orders(spark, sf_dir, F.col("o_orderstatus")),
        ORDERS,
        existed=F.col("o_orderstatus") == "F",
        updated=urgent | high,
        values={"amount": F.col("amount") + F.lit(1).cast("decimal(10,2)")},
        deleted=pending & (low | high),
        keyed=F.col("created_at") < F.lit("1998-01-01").cast("timestamp_ntz"),
    )


def users_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    building, machinery = (F.col("c_mktsegment") == s for s in ("BUILDING", "MACHINERY"))
    return history(
        users(spark, sf_dir, F.col("c_mktsegment"), F.col("c_nationkey")),
        USERS,
        existed=F.col("c_nationkey") < 5,
        updated=building | machinery,
        values={"full_name": F.concat("full_name", F.lit(" Updated"))},
        deleted=machinery & (F.col("c_nationkey") >= 12),
        keyed=F.col("c_nationkey") >= 18,
    )


def events_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history(
        events(spark, sf_dir),
        EVENTS,
        existed=F.col("kind") == "signup",
        updated=F.col("kind").isin("purchase", "error"),
        values={"value": F.col("value") + 1},
        deleted=F.col("kind") == "error",
        keyed=F.col("value") < 10,
    )


def order_records(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    return to_records(orders_history(spark, sf_dir), ORDERS, **how)


def user_records(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    return to_records(users_history(spark, sf_dir), USERS, **how)


def event_records(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    return to_records(events_history(spark, sf_dir), EVENTS, **how)


def zoneless(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, as the given tables have them. They are those of clocks in UTC
    whatever the session's zone, which is left as it is."""
    return df.select(
        *(
            zoneless_utc(F.col(f.name)).alias(f.name)
            if f.dataType.typeName() == "timestamp"
            else F.col(f.name)
            for f in df.schema.fields
        )
    )
