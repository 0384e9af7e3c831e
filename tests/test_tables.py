"""Joins, constraints, inserts and generated rows."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rowtide import ORDERS, USERS
from rowtide.operators import (
    cascade_deleted,
    cascade_survivors,
    change_rate,
    ingest_summary,
    insert_if_absent,
    new_orders,
    new_users,
    null_violations,
    orphans,
    pk_violations,
    precision_violations,
    rate_alerts,
    serial_ids,
    unique_violations,
    with_parent,
)


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame([(1, 10), (2, 10), (3, 20), (4, None), (5, 99)], "id int, user_id int")


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame([(10, "Ann"), (20, "Bob"), (30, "Cy")], "id int, full_name string")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_with_parent(orders, users):
    got = sorted(tuple(r) for r in with_parent(orders, users, "user_id", ["full_name"]).collect())
    assert got == [(1, 10, "Ann"), (2, 10, "Ann"), (3, 20, "Bob")]


def test_orphans(orders, users):
    assert ids(orphans(orders, users, "user_id")) == [5]


def test_cascade(orders, users):
    gone = users.filter("id = 10")
    gone = gone.unionByName(gone)
    assert ids(cascade_deleted(orders, gone, "user_id")) == [1, 2]
    assert ids(cascade_survivors(orders, gone, "user_id")) == [3, 4, 5]


def test_hot_parent_is_split_in_the_join(spark, users):
    """Two thirds of the children under one parent: the adaptive join splits that partition."""
    children = spark.range(0, 300_000, numPartitions=8).select(
        "id", F.when(F.col("id") % 3 > 0, 10).otherwise(F.col("id")).alias("user_id"),
        F.repeat(F.lit("x"), 20).alias("fill"),
    )
    many = spark.range(300_000).select("id", F.lit("n").alias("full_name"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    for name, value in conf.items():
        spark.conf.set(name, value)
    try:
        joined = with_parent(children, many, "user_id", ["full_name"])
        survivors = cascade_survivors(children, many.filter("id > 100"), "user_id")
        lost = orphans(children, many.filter("id <> 10"), "user_id")
        counts, plans = [], []
        for df in (joined, survivors, lost):
            counts.append(df.agg(F.sum("id"), F.count("*")).first()[1])
            df.write.format("noop").mode("overwrite").save()
            rows = df.groupBy().count()
            rows.collect()
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
    finally:
        for name in conf:
            spark.conf.unset(name)
    assert counts == [300_000, 200_000 + 34, 200_000]
    assert all("skew=true" in plan for plan in plans)


def test_insert_if_absent(spark):
    existing = spark.createDataFrame([("a@x",), ("b@x",)], "email string")
    incoming = spark.createDataFrame(
        [(3, "c@x", "late"), (1, "c@x", "first"), (2, "a@x", "held"), (4, None, "no key"), (5, "d@x", "only")],
        "arrival int, email string, full_name string",
    )
    got = insert_if_absent(existing, incoming, "email", ["arrival"])
    assert got.columns == incoming.columns
    assert sorted(r.full_name for r in got.collect()) == ["first", "only"]


def test_insert_if_absent_with_a_hot_key(spark):
    incoming = spark.range(3000).select(
        F.col("id").alias("arrival"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("email"),
    )
    existing = spark.range(1000).select(F.lit("1").alias("email"))
    got = insert_if_absent(existing, incoming, "email", ["arrival"])
    assert got.count() == 2000
    assert got.filter("email = 'hot'").first().arrival == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan


def test_a_large_table_is_not_shuffled_for_its_absent_rows(spark, tmp_path):
    """With few arrivals these are broadcast; else the table's keys alone are shuffled."""
    path = str(tmp_path / "users")
    spark.range(1000).select("id", F.col("id").cast("string").alias("email"), F.lit("n").alias("full_name")).write.parquet(path)
    existing = spark.read.parquet(path)
    incoming = spark.createDataFrame([(1, "5", "x"), (2, "new", "y")], "arrival int, email string, full_name string")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(threshold)
    try:
        for value, expected in (("10MB", "BroadcastHashJoin"), ("-1", "SortMergeJoin")):
            spark.conf.set(threshold, value)
            got = insert_if_absent(existing, incoming, "email", ["arrival"])
            assert [r.full_name for r in got.collect()] == ["y"]
            plan = got._jdf.queryExecution().executedPlan().toString()
            assert f"{expected}" in plan and "LeftSemi" in plan
            scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
            assert scans and all("ReadSchema: struct<email:string>" in line for line in scans)
    finally:
        spark.conf.set(threshold, old)


def test_constraints(spark):
    users = spark.createDataFrame(
        [(1, "Ann", "a@x", datetime(2024, 1, 1)), (1, None, "b@x", datetime(2024, 1, 1)),
         (2, "Bob", "a@x", None), (3, "Cy", None, datetime(2024, 1, 1)), (4, "Di", None, datetime(2024, 1, 1))],
        "id int, full_name string, email string, created_at timestamp",
    )
    assert [tuple(r) for r in pk_violations(users, USERS).collect()] == [(1, 2)]
    assert [tuple(r) for r in unique_violations(users, USERS).collect()] == [("email", "a@x", 2)]
    got = sorted(tuple(r) for r in null_violations(users, USERS).collect())
    assert got == [(1, "full_name"), (2, "created_at"), (3, "email"), (4, "email")]
    with pytest.raises(ValueError):
        unique_violations(users, ORDERS)
    plan = null_violations(users, USERS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_precision(spark):
    df = spark.createDataFrame([(1, 1.25), (2, 1.255), (3, 1e9), (4, None), (5, -99999999.99)], "id int, x double")
    got = sorted((r.id, r.violation) for r in precision_violations(df, "x").collect())
    assert got == [(2, "rounded"), (3, "overflow")]


def test_generated_users(spark):
    got = new_users(spark, 5, first_id=7)
    assert ids(got) == [7, 8, 9, 10, 11]
    assert got.select("email").distinct().count() == 5
    assert [f.name for f in got.schema] == USERS.columns


def test_generated_orders_by_chance(spark):
    got = new_orders(new_users(spark, 200)).collect()
    per_user = {}
    for r in got:
        per_user.setdefault(r.user_id, []).append(r.n)
        assert Decimal("10.00") <= r.amount <= Decimal("500.00")
        assert r.product_name == r.product_name.capitalize()
    assert len(per_user) == 200  # no user goes without
    assert {len(ns) for ns in per_user.values()} == {1, 2, 3}
    assert all(ns == list(range(1, len(ns) + 1)) for ns in map(sorted, per_user.values()))


def test_serial_ids(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(8)
    got = serial_ids(rows, ["x"], last_id=500, partitions=5)
    assert [tuple(r) for r in got.orderBy("id").collect()] == [(501 + i, i) for i in range(1000)]


def test_serial_ids_of_equal_values_spread_over_tasks(spark):
    rows = spark.range(0, 9000, numPartitions=8).select(F.lit(1).alias("x"))
    got = serial_ids(rows, ["x"], partitions=4)
    assert sorted(r.id for r in got.collect()) == list(range(1, 9001))
    sizes = [len(p) for p in got.rdd.glom().collect()]
    assert max(sizes) < 6000


def test_ingest_summary(spark, orders, users):
    assert tuple(ingest_summary(users, orders).first()) == (3, 5)
    assert tuple(ingest_summary(users.limit(0), orders.limit(0)).first()) == (0, 0)


def test_change_rate(spark):
    log = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 10), False), (datetime(2024, 1, 1, 0, 59), True), (datetime(2024, 1, 1, 1, 0), None)],
        "event_ts timestamp, is_deleted boolean",
    )
    rates = change_rate(log)
    got = sorted((r.n_changes, r.n_deletes) for r in rates.collect())
    assert got == [(1, 0), (2, 1)]
    assert rate_alerts(rates, 1).count() == 1


def test_a_parent_is_never_broadcast(spark):
    """Its size is an estimate by compressed files, whatever was decoded from them."""
    child = spark.range(9).select("id", (F.col("id") % 3).alias("user_id"))
    found = with_parent(child, spark.range(2).select("id", F.lit("a").alias("name")), "user_id", ["name"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan and found.count() == 6
