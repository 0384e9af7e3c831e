"""Answers kept up to date slice by slice against the same computed anew."""

import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rowtide import ORDERS, USERS
from rowtide.operators import count_rows, current_state, with_parent
from rowtide.streaming import MaintainedJoin

T0 = datetime(2024, 1, 1)


def order(op, lsn, id, user=1, name="Anvil"):
    if op == "t":
        return (None, "t", None, None, None, None, None, T0, False, lsn)
    return (id, op, id, user, name, Decimal("1.00"), T0, T0, op == "d", lsn)


def user(op, lsn, id, name="Ann", email="e"):
    if op == "t":
        return (None, "t", None, None, None, None, T0, False, lsn)
    return (id, op, id, name, email, T0, T0, op == "d", lsn)


def log(spark, spec, rows):
    return spark.createDataFrame(rows, spec.log_type().add("lsn", "long"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def check(spark, join, orders, users):
    orders, users = log(spark, ORDERS, orders), log(spark, USERS, users)
    expected = with_parent(current_state(orders, ORDERS), current_state(users, USERS, columns=["id", "full_name"]), "user_id", ["full_name"])
    assert rows(join.read()) == rows(expected)
    assert join.count(ORDERS).first()[0] == count_rows(orders, ORDERS).first()[0]
    assert join.count(USERS).first()[0] == count_rows(users, USERS).first()[0]
    return rows(expected)


def joined(spark, path, **how):
    return MaintainedJoin(spark, str(path), ORDERS, USERS, "user_id", ["full_name"], **{"buckets": 4, **how})


def test_each_kind_of_change(spark, tmp_path):
    join, orders, users = joined(spark, tmp_path), [], []
    slices = [
        # An order before its user; one without; one of nobody.
        ([order("c", 1, 1), order("c", 2, 2, 9), order("c", 3, 3, None)], []),
        ([], [user("c", 4, 1), user("c", 5, 2, "Bob")]),
        # To another user, and the name of the user, at once; a change of no needed column.
        ([order("u", 6, 1, 2), order("c", 7, 4, 1)], [user("u", 8, 2, "Bert"), user("u", 9, 1, "Ann", "other")]),
        # An older change that comes late, the same again, a user who goes.
        ([order("u", 5, 1, 1, "late"), order("c", 7, 4, 1)], [user("d", 10, 2)]),
        # Both tables emptied, and filled again.
        ([order("t", 11, None), order("c", 12, 5, 2)], [user("t", 13, None), user("c", 14, 2, "Bea")]),
        # From before the truncate.
        ([order("c", 10, 6, 2)], [user("c", 12, 3)]),
        ([order("d", 15, 5, 2)], []),
        ([order("c", 16, 5, 2, "back")], [user("d", 17, 2), user("c", 18, 2, "Bo")]),
    ]
    found = []
    for number, (some_orders, some_users) in enumerate(slices):
        orders += some_orders
        users += some_users
        for _ in range(2 if number in (2, 4) else 1):  # a slice that is applied again
            join.apply(number, log(spark, ORDERS, some_orders), log(spark, USERS, some_users))
        found.append(len(check(spark, join, orders, users)))
        if number == 5:
            join.fold()
            check(spark, join, orders, users)
    assert found == [0, 1, 2, 1, 1, 1, 0, 1]


def test_random_slices(spark, tmp_path):
    rng = random.Random(4)
    join, orders, users, lsn = joined(spark, tmp_path), [], [], 0
    for number in range(4):
        some = ([], [])
        for _ in range(60):
            lsn += 1
            at = lsn if rng.random() < 0.9 else max(1, lsn - 70) + 1000 * number
            if rng.random() < 0.7:
                some[0].append(order(rng.choice("ccud"), lsn, rng.randint(1, 25), rng.choice([1, 1, 1, *range(2, 9), None]), f"v{at}"))
            else:
                some[1].append(user(rng.choice("cud"), lsn, rng.randint(1, 9), f"n{at}"))
        rng.shuffle(some[0])
        orders, users = orders + some[0], users + some[1]
        join.apply(number, log(spark, ORDERS, some[0]), log(spark, USERS, some[1]))
    assert check(spark, join, orders, users)


def test_a_slice_that_fails_is_not_seen(spark, tmp_path, monkeypatch):
    join = joined(spark, tmp_path)
    join.apply(0, log(spark, ORDERS, [order("c", 1, 1)]), log(spark, USERS, [user("c", 2, 1)]))
    before = rows(join.read())
    slices = log(spark, ORDERS, [order("d", 3, 1), order("c", 4, 2)]), log(spark, USERS, [user("u", 5, 1, "Bo")])
    with monkeypatch.context() as patch:
        patch.setattr(join.counts, "write", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            join.apply(1, *slices)
    assert rows(join.read()) == before and join.done == 0
    join.apply(1, *slices)
    assert [r[-1] for r in rows(join.read())] == ["Bo"] and join.count(ORDERS).first()[0] == 1


def test_only_the_slice_and_matching_buckets_are_read(spark, tmp_path):
    path = tmp_path / "join"
    join = joined(spark, path, buckets=64)
    join.apply(0, log(spark, ORDERS, [order("c", i, i, i % 50) for i in range(1, 400)]), log(spark, USERS, [user("c", i, i) for i in range(50)]))
    state = join.states["orders"]
    few = log(spark, ORDERS, [order("u", 1000, 7, 3)])
    buckets = state.touched([F.col("pk_id")], few)
    assert len(buckets) == 1
    rows_read = state.read(0, buckets)
    plan = rows_read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert rows_read.select("bucket").distinct().count() == 1 < state.read(0).select("bucket").distinct().count()

    # What a small slice does not need may be gone: neither other buckets nor the result are read.
    users = {3, 7}
    keep = {"state-orders": buckets, "state-users": join.states["users"].touched([F.col("u")], spark.createDataFrame([(u,) for u in users], "u int")), "by-parent": [], "result": []}
    aside = tmp_path / "aside"
    aside.mkdir()
    for name, some in keep.items():
        for folder in (path / name / "batch_id=0").glob("bucket=*"):
            if int(folder.name.removeprefix("bucket=")) not in some:
                folder.rename(aside / f"{name}-{folder.name}")
    join.apply(1, few, log(spark, USERS, []))
    changed = join.result.read(1).filter("batch_id = 1").select("id", "user_id", "sign").collect()
    assert sorted(map(tuple, changed)) == [(7, 3, 1), (7, 7, -1)]


def test_a_fold_keeps_images_of_its_last_slice_alone(spark, tmp_path):
    """Images before and after are read by the slice that wrote them; under its number it may be applied again."""
    join = joined(spark, tmp_path)
    orders, users = [order("c", i, i) for i in range(1, 9)], [user("c", 20, 1)]
    join.apply(0, log(spark, ORDERS, orders), log(spark, USERS, users))
    more = [order("u", 30, 3, 1, "new")]
    join.apply(1, log(spark, ORDERS, more), log(spark, USERS, []))
    join.fold()
    kept = join.states["orders"].read(1)
    assert kept.count() == 8 and rows(kept.filter("before IS NOT NULL OR after IS NOT NULL").select("pk_id", "batch_id")) == [(3, 1)]
    check(spark, join, orders + more, users)
    join.apply(1, log(spark, ORDERS, more), log(spark, USERS, []))
    check(spark, join, orders + more, users)
