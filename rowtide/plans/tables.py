"""Queries on source tables: reads, joins, constraints, inserts and generated rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.operators import constraints, generate, relations
from rowtide.plans import sql
from rowtide.plans import testdata as td
from rowtide.plans.registry import query


@query("SELECT count(*) AS n_rows FROM customer")
def count_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SELECT COUNT(*) FROM users."""
    return td.users(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"))


@query("SELECT count(*) AS n_rows FROM orders")
def count_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SELECT COUNT(*) FROM orders."""
    return td.orders(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"))


@query(
    f"""SELECT id, full_name, email, created_at FROM ({sql.USERS}) ORDER BY id LIMIT 10"""
)
def select_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SELECT * FROM users LIMIT 10, in key order."""
    return td.users(spark, sf_dir).orderBy("id").limit(10)


@query("SELECT c_custkey AS id FROM customer")
def user_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SELECT id FROM users."""
    return td.users(spark, sf_dir).select("id")


_JOINED = f"""
SELECT o.id, o.user_id, o.product_name, o.amount, o.created_at, u.full_name
FROM ({sql.ORDERS}) o JOIN ({sql.USERS}) u ON o.user_id = u.id"""


@query(f"{_JOINED} ORDER BY o.id LIMIT 10")
def orders_with_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SELECT o.*, u.full_name FROM orders o JOIN users u ... LIMIT 10, in key order."""
    return orders_with_user_all(spark, sf_dir).orderBy("id").limit(10)


@query(_JOINED)
def orders_with_user_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with the name of its user."""
    return relations.with_parent(
        td.orders(spark, sf_dir), td.users(spark, sf_dir), "user_id", ["full_name"]
    )


@query(
    f"""
WITH u AS ({sql.USERS})
SELECT full_name, email FROM u
WHERE email NOT IN (SELECT email FROM u WHERE c_mktsegment IN ('HOUSEHOLD', 'FURNITURE'))"""
)
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users to add to a table that holds two segments: every user arrives twice, and the
    first arrival counts."""
    segment = F.col("c_mktsegment")
    table = td.users(spark, sf_dir, segment)
    existing = table.filter(segment.isin("HOUSEHOLD", "FURNITURE"))
    arrivals = table.select(
        F.explode(F.array(F.lit(2), F.lit(1))).alias("arrival"), "full_name", "email"
    ).withColumn(
        "full_name",
        F.when(F.col("arrival") == 2, F.concat("full_name", F.lit(" again"))).otherwise(
            F.col("full_name")
        ),
    )
    return relations.insert_if_absent(existing, arrivals, "email", ["arrival"]).drop("arrival")


@query(
    """
SELECT o_orderkey AS id, o_custkey AS user_id FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer
                  WHERE c_custkey = o_custkey AND c_mktsegment <> 'MACHINERY')"""
)
def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose user does not exist, where one segment of users is missing."""
    kept = td.users(spark, sf_dir, F.col("c_mktsegment")).filter(
        F.col("c_mktsegment") != "MACHINERY"
    )
    missing = relations.orphans(td.orders(spark, sf_dir), kept, "user_id")
    return missing.select("id", "user_id")


@query(
    """
SELECT o_orderkey AS id, o_custkey AS user_id FROM orders
WHERE EXISTS (SELECT 1 FROM customer
              WHERE c_custkey = o_custkey AND c_mktsegment = 'MACHINERY')"""
)
def cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that go when the users of a segment are deleted."""
    gone = td.users(spark, sf_dir, F.col("c_mktsegment")).filter(
        F.col("c_mktsegment") == "MACHINERY"
    )
    deleted = relations.cascade_deleted(td.orders(spark, sf_dir), gone, "user_id")
    return deleted.select("id", "user_id")


@query(
    """
SELECT o_orderkey AS id, o_custkey AS user_id FROM orders
WHERE NOT EXISTS (SELECT 1 FROM customer
                  WHERE c_custkey = o_custkey AND c_mktsegment = 'MACHINERY')"""
)
def cascade_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that stay when the users of a segment are deleted."""
    gone = td.users(spark, sf_dir, F.col("c_mktsegment")).filter(
        F.col("c_mktsegment") == "MACHINERY"
    )
    kept = relations.cascade_survivors(td.orders(spark, sf_dir), gone, "user_id")
    return kept.select("id", "user_id")


@query(
    """
SELECT id, count(*) AS n_rows
FROM (SELECT o_orderkey AS id FROM orders
      UNION ALL SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
GROUP BY id HAVING count(*) > 1"""
)
def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that stand twice, where the urgent orders were stored again."""
    table = td.orders(spark, sf_dir)
    again = table.filter(F.col("product_name") == "1-URGENT")
    return constraints.pk_violations(table.unionByName(again), td.ORDERS)


@query(
    f"""
WITH u AS ({sql.USERS}),
stored AS (SELECT email FROM u
           UNION ALL SELECT email FROM u WHERE c_mktsegment = 'BUILDING')
SELECT 'email' AS "column", email AS value, count(*) AS n_rows
FROM stored GROUP BY email HAVING count(*) > 1"""
)
def unique_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Emails that stand twice, where a segment of users was stored under new ids."""
    table = td.users(spark, sf_dir, F.col("c_mktsegment"))
    again = table.filter(F.col("c_mktsegment") == "BUILDING").withColumn("id", -F.col("id") - 1)
    return constraints.unique_violations(table.unionByName(again), td.USERS)


@query(
    f"""
WITH u AS ({sql.USERS})
SELECT id, 'full_name' AS "column" FROM u WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT id, 'email' FROM u WHERE c_nationkey < 5"""
)
def null_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns that are null but must not be."""
    table = td.users(spark, sf_dir, F.col("c_mktsegment"), F.col("c_nationkey"))
    holes = table.withColumns(
        {
            "full_name": F.when(F.col("c_mktsegment") != "BUILDING", F.col("full_name")),
            "email": F.when(F.col("c_nationkey") >= 5, F.col("email")),
        }
    )
    return constraints.null_violations(holes, td.USERS)


@query(
    """
WITH lines AS (
  SELECT l_orderkey, l_linenumber,
         l_extendedprice * l_quantity * l_quantity * (1 + l_tax) AS price FROM lineitem)
SELECT *, CASE WHEN TRY_CAST(price AS DECIMAL(10,2)) IS NULL THEN 'overflow' ELSE 'rounded' END
       AS violation
FROM lines
WHERE TRY_CAST(price AS DECIMAL(10,2)) IS NULL
      OR CAST(TRY_CAST(price AS DECIMAL(10,2)) AS DOUBLE) <> price"""
)
def precision_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products that a column of ten digits and two decimals refuses, or rounds."""
    quantity = F.col("l_quantity")
    lines = td.load(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_extendedprice") * quantity * quantity * (1 + F.col("l_tax"))).alias("price"),
    )
    return constraints.precision_violations(lines, "price")


NOW = "2024-03-01 00:00:00"


def at_now():
    return F.lit(NOW).cast("timestamp_ntz")


@query(
    f"""
WITH g AS (SELECT unnest(range((SELECT max(c_custkey) + 1 FROM customer),
                               (SELECT max(c_custkey) + 1 + count(*) FROM customer))) AS id)
SELECT id, 'User ' || lpad(CAST(id AS VARCHAR), 12, '0') AS full_name,
       'user' || lpad(CAST(id AS VARCHAR), 12, '0') || '@example.com' AS email,
       TIMESTAMP '{NOW}' AS created_at
FROM g"""
)
def gen_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many new users as there are, with the ids that follow."""
    size = td.users(spark, sf_dir).agg(F.count(F.lit(1)), F.max("id")).first()
    return generate.new_users(spark, size[0], size[1] + 1, now=at_now())


def by_rule() -> dict[str, Column]:
    """What generated orders otherwise draw by chance."""
    user, n = F.col("id"), F.col("n")
    words = F.array(*(F.lit(w) for w in generate.WORDS))
    return {
        "count": (user % 3 + 1).cast("int"),
        "share": (2 * ((user * 7919 + n * 104729) % 50000) + 1) / F.lit(100000),
        "word": F.element_at(words, ((user + n) % 7 + 1).cast("int")),
        "now": at_now(),
    }


def ruled_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return generate.new_orders(td.users(spark, sf_dir), **by_rule())


WORDS_SQL = ", ".join(f"'{w.capitalize()}'" for w in generate.WORDS)
_GENERATED = f"""
WITH g AS (SELECT c_custkey AS user_id, unnest(range(1, c_custkey % 3 + 2)) AS n FROM customer),
made AS (
SELECT user_id, CAST(n AS INTEGER) AS n, [{WORDS_SQL}][(user_id + n) % 7 + 1] AS product_name,
       CAST(round(10.0::DOUBLE + 490.0::DOUBLE
            * ((2 * ((user_id * 7919 + n * 104729) % 50000) + 1) / 100000.0::DOUBLE), 2)
            AS DECIMAL(10,2)) AS amount,
       TIMESTAMP '{NOW}' AS created_at
FROM g)
"""


@query(f"{_GENERATED} SELECT user_id, n, product_name, amount, created_at FROM made")
def gen_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One to three orders for every user."""
    return ruled_orders(spark, sf_dir)


@query(
    f"""{_GENERATED}
SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY user_id, n) AS id,
       user_id, n, product_name, amount, created_at
FROM made"""
)
def serial_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated orders under the ids that follow those of the table."""
    last = td.orders(spark, sf_dir).agg(F.max("id")).first()[0]
    return generate.serial_ids(ruled_orders(spark, sf_dir), ["user_id", "n"], last)


@query(
    f"""{_GENERATED}
SELECT (SELECT count(*) FROM customer) AS users_total,
       (SELECT count(*) FROM made) AS orders_added"""
)
def ingest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a cycle leaves: all users, and the orders it added."""
    return generate.ingest_summary(td.users(spark, sf_dir), ruled_orders(spark, sf_dir))
