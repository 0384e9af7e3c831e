"""Queries whose answers are kept up to date slice by slice."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.operators import interval_join
from rowtide.operators.capture import to_records
from rowtide.plans import sql
from rowtide.plans import testdata as td
from rowtide.plans.registry import ORACLES, query
from rowtide.plans.states import orders_log, users_log
from rowtide.plans.streams import ONCE, Replay, first_and_later
from rowtide.session import scratch
from rowtide.streaming import History, MaintainedJoin, start_maintained_join


def orders_of_users(spark: SparkSession) -> MaintainedJoin:
    path = scratch(spark, "maintained")
    return MaintainedJoin(spark, path, td.ORDERS, td.USERS, "user_id", ["full_name"], buckets=8)


def three_slices(log: DataFrame, spec, folder: str) -> list[DataFrame]:
    """A stored log in three slices: what was there first, updates, and deletes."""
    log.write.partitionBy("op").parquet(folder)
    kept = log.sparkSession.read.schema(log.schema).parquet(folder).select(*log.columns)
    ops = (("r", "c"), ("u",), ("d",))
    return [kept.filter(F.col("op").isin(*some)) for some in ops]


def applied(spark: SparkSession, sf_dir: str) -> MaintainedJoin:
    """The join after three slices; users are one behind, so that orders come before their users."""
    join, folder = orders_of_users(spark), scratch(spark, "slices")
    orders = three_slices(orders_log(spark, sf_dir), td.ORDERS, f"{folder}/orders")
    users = three_slices(users_log(spark, sf_dir), td.USERS, f"{folder}/users")
    join.apply(0, orders[0], users[0].limit(0))
    join.apply(1, orders[1], users[0])
    join.fold()
    join.apply(2, orders[2], users[1].unionByName(users[2]))
    return join


@query(ORACLES["lake_orders_with_user"])
def orders_with_user_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the names of their users, kept up to date over three slices of both logs."""
    return td.zoneless(applied(spark, sf_dir).read())


@query(
    f"""SELECT 'orders' AS name, count(*) AS n_rows FROM ({sql.ORDERS_STATE} SELECT * FROM state)
UNION ALL SELECT 'users', count(*) FROM ({sql.USERS_STATE} SELECT * FROM state)"""
)
def count_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COUNT(*) of orders and users, kept up to date in the same way."""
    join = applied(spark, sf_dir)
    counts = [join.count(spec).select(F.lit(spec.name).alias("name"), "n_rows") for spec in (td.ORDERS, td.USERS)]
    return counts[0].unionByName(counts[1])


@query(ORACLES["lake_orders_with_user"])
def stream_orders_with_user_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same answer, kept up to date by a stream of both tables' records in two runs."""
    place, join = Replay(spark), orders_of_users(spark)
    orders, users = (first_and_later(h(spark, sf_dir)) for h in (td.orders_history, td.users_history))
    for some_orders, some_users in zip(orders, users, strict=True):
        place.put(to_records(some_orders, td.ORDERS).unionByName(to_records(some_users, td.USERS)))
        start_maintained_join(place.records(), join, place.checkpoint, trigger=ONCE).awaitTermination()
    return td.zoneless(join.read())


def orders_history(spark: SparkSession, sf_dir: str) -> History:
    """The versions of orders after three slices: updates come last, behind the deletes that follow them."""
    folder = scratch(spark, "history")
    first, updates, deletes = three_slices(orders_log(spark, sf_dir), td.ORDERS, f"{folder}/log")
    history = History(spark, folder, td.ORDERS, buckets=8)
    for number, slice_ in enumerate((first, deletes, updates)):
        history.apply(number, slice_)
        if number == 1:
            history.fold()
    return history


_VERSIONS = f"""{sql.ORDERS_LOG},
versions AS (
SELECT id, user_id, product_name, amount, created_at, is_deleted, lsn AS valid_from, event_ts AS from_ts,
       lead(lsn) OVER of_key AS valid_to, lead(event_ts) OVER of_key AS to_ts
FROM log WINDOW of_key AS (PARTITION BY pk_id ORDER BY lsn))
"""


@query(
    f"""{_VERSIONS} SELECT id, user_id, product_name, amount, created_at, valid_from, valid_to, from_ts, to_ts
FROM versions WHERE NOT is_deleted"""
)
def orders_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row that the orders table ever had, with the positions and times between which it held, out of
    a table of versions that three slices extended."""
    columns = [*td.ORDERS.columns, "valid_from", "valid_to", "from_ts", "to_ts"]
    return td.zoneless(orders_history(spark, sf_dir).live().select(*columns))


@query(
    f"""{_VERSIONS}
SELECT e.pk_id, e.lsn, count(v.id) AS n_orders, sum(v.amount) AS amount
FROM log e JOIN versions v
  ON v.user_id = e.user_id AND NOT v.is_deleted AND v.from_ts <= e.event_ts AND coalesce(v.to_ts > e.event_ts, true)
GROUP BY e.pk_id, e.lsn"""
)
def orders_as_of_each_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At each change of an order, the orders that its user had just then, and what they came to."""
    rows = orders_history(spark, sf_dir).live().select("user_id", "id", "amount", "from_ts", "to_ts")
    events = orders_log(spark, sf_dir, columns=["user_id"]).select("pk_id", "lsn", "user_id", "event_ts")
    found = interval_join(events, rows, ["user_id"], "event_ts", "from_ts", "to_ts", resolution="1 day")
    return found.groupBy("pk_id", "lsn").agg(
        F.count("id").alias("n_orders"), F.sum("amount").cast("decimal(38,2)").alias("amount")
    )
