"""One cycle of periodic ingest on the source tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.operators import generate
from rowtide.operators.capture import insert_events, to_records
from rowtide.operators.changelog import decode
from rowtide.operators.relations import insert_if_absent
from rowtide.plans import sql
from rowtide.plans import testdata as td
from rowtide.plans.registry import query
from rowtide.plans.tables import NOW, WORDS_SQL, at_now, by_rule


def ingest_cycle(
    users: DataFrame, orders: DataFrame, incoming: DataFrame, **drawn: Column
) -> tuple[DataFrame, DataFrame]:
    """The users and orders that a cycle adds: incoming users whose email is new, then one to
    three orders for every user, old and new, under the ids that follow.

    ``drawn`` goes to ``new_orders``.
    """
    added = insert_if_absent(users, incoming, "email", ["id"])
    last = orders.agg(F.max("id")).first()[0] or 0
    placed = generate.new_orders(users.unionByName(added), **drawn)
    return added, generate.serial_ids(placed, ["user_id", "n"], last).drop("n")


@query(
    f"""
WITH everyone AS (
SELECT c_custkey AS user_id FROM customer
UNION ALL
SELECT unnest(range((SELECT max(c_custkey) + 1 FROM customer),
                    (SELECT max(c_custkey) + 1 + count(*) FROM customer)))),
g AS (SELECT user_id, unnest(range(1, user_id % 3 + 2)) AS n FROM everyone),
placed AS (
SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY user_id, n) AS id,
       user_id, [{WORDS_SQL}][(user_id + n) % 7 + 1] AS product_name,
       CAST(round(10.0::DOUBLE + 490.0::DOUBLE
            * ((2 * ((user_id * 7919 + n * 104729) % 50000) + 1) / 100000.0::DOUBLE), 2)
            AS DECIMAL(20,2)) AS amount
FROM g)
SELECT id AS pk_id, 'c' AS op, id, user_id, product_name, amount,
       TIMESTAMP '{NOW}' AS created_at, TIMESTAMP '{NOW}' AS event_ts, false AS is_deleted
FROM placed"""
)
def ingest_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders log of a cycle. As many new users arrive as there are, and all the old ones
    again, which are held back."""
    users = td.users(spark, sf_dir)
    size = users.agg(F.count(F.lit(1)), F.max("id")).first()
    incoming = generate.new_users(spark, size[0], size[1] + 1, now=at_now()).unionByName(users)
    _, placed = ingest_cycle(users, td.orders(spark, sf_dir), incoming, **by_rule())
    events = insert_events(placed, td.ORDERS, F.col("created_at"), F.col("id"))
    return td.zoneless(decode(to_records(events, td.ORDERS), td.ORDERS))
