"""Summaries, sets of keys, profiles and common positions; topics joined while they arrive."""

import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from rowtide import ORDERS, USERS, TableSpec
from rowtide.operators import (
    absent_by_bitmap,
    common_position,
    consistent_states,
    diff_by_summary,
    diff_events,
    differing_leaves,
    extended_bitmap,
    figures,
    key_bitmap,
    orphans_by_bitmap,
    profile,
    progress_marks,
    rolled_up,
    summary,
    united,
)
from rowtide.plans import testdata as td
from rowtide.sources import RECORD_TYPE, read_replay, read_table, write_replay
from rowtide.specs import Field
from rowtide.streaming import append_to_table, joined_logs, late_parents, orphaned, with_parents

PAIRS = TableSpec("pairs", (Field("id", "long"), Field("a", "long"), Field("b", "long"), Field("t", "text")))
T0 = datetime(2024, 1, 1)
ONCE = {"availableNow": True}


def pairs(spark, rows):
    return spark.createDataFrame(rows, "id long, a long, b long, t string")


def changes(df):
    return sorted((repr((r.op, r.before, r.after)) for r in df.collect()))


@pytest.mark.parametrize("depth,levels", [(1, ()), (5, (2,)), (16, (4, 8, 12))])
def test_diff_by_summary_equals_the_full_diff(spark, depth, levels):
    rng = random.Random(depth)
    old = [(i, rng.randint(0, 3), rng.choice([None, 1]), rng.choice("xy")) for i in range(300)]
    new = [r for r in old if r[0] % 50] + [(1000, 1, 1, "n")]
    # Null and a value that change places, repeats in both versions and in one, null keys.
    new = [(7, None, 1, "x") if r[0] == 7 else (9, 1, 1, None) if r[0] == 9 else r for r in new]
    old = [(7, 1, None, "x") if r[0] == 7 else r for r in old] + [(20, 0, 0, "r"), (None, 1, 1, "k")]
    new += [(20, 0, 0, "r"), (21, 0, 0, "r")]
    versions = pairs(spark, old), pairs(spark, new)
    at = (PAIRS, F.lit(T0), F.lit(1))
    full = changes(diff_events(*versions, *at))
    assert changes(diff_by_summary(*versions, *at, depth=depth, levels=levels)) == full and len(full) > 8
    same = summary(versions[0], PAIRS, depth=depth), summary(versions[0].repartition(7), PAIRS, depth=depth)
    assert differing_leaves(*same, levels=levels).count() == 0
    assert rolled_up(same[0], depth).first().n_rows == len(old)
    assert diff_by_summary(versions[0].limit(0), versions[1].limit(0), *at).count() == 0


def test_rows_of_equal_leaves_are_not_shuffled(spark, tmp_path):
    table = spark.range(20_000).select("id", (F.col("id") % 7).alias("a"), F.lit(1).cast("long").alias("b"), F.lit("t").alias("t"))
    new = table.withColumn("a", F.when(F.col("id") == 5, 9).otherwise(F.col("a")))
    for name, version in (("old", table), ("new", new)):
        summary(version, PAIRS, depth=12).write.parquet(str(tmp_path / name))
    kept = {f"{n}_summary": spark.read.parquet(str(tmp_path / n)) for n in ("old", "new")}
    leaves = differing_leaves(kept["old_summary"], kept["new_summary"])
    assert leaves.count() == 1
    seen = Observation("compared")
    found = diff_by_summary(table, new, PAIRS, F.lit(T0), F.lit(1), depth=12, **kept)
    assert found.observe(seen, F.count(F.lit(1)).alias("n")).count() == 1
    from rowtide.operators.summaries import leaf_of
    left = new.withColumn("leaf", leaf_of(["id"], 12)).join(leaves, "leaf", "left_semi").count()
    assert left < 30


def test_bitmaps_hold_keys_exactly(spark):
    keys = [0, 1, -1, 32768, 32769, -32768, -32769, 2**40, -(2**40), 2**62, 77, 77]
    held = key_bitmap(spark.createDataFrame([(k,) for k in [*keys, None]], "id long"), "id")
    asked = sorted({k + d for k in keys for d in (-1, 0, 1)})
    rows = spark.createDataFrame([(k, k) for k in [*asked, None, 78, 78]], "id long, n long")
    missing = sorted(r.id for r in absent_by_bitmap(rows, held, "id").collect())
    assert missing == sorted([k for k in asked if k not in keys] + [78, 78])
    more = extended_bitmap(held, spark.createDataFrame([(78,), (76,), (2**50,)], "id long"), "id")
    assert sorted(r.id for r in orphans_by_bitmap(rows, more, "id").collect()) == [k for k in missing if k not in (76, 78)]
    assert more.select(F.sum(F.bitmap_count("bits"))).first()[0] == len(set(keys)) + 3
    none = held.limit(0)
    assert absent_by_bitmap(rows, none, "id").count() == len(asked) + 2 and key_bitmap(rows.limit(0), "id").count() == 0


def test_orphans_are_found_without_the_parents(spark, tmp_path):
    spark.range(1, 100_000).write.parquet(str(tmp_path / "users"))
    key_bitmap(spark.read.parquet(str(tmp_path / "users")), "id").write.parquet(str(tmp_path / "bits"))
    held = spark.read.parquet(str(tmp_path / "bits"))
    assert held.count() == 4
    children = spark.range(1000).select("id", (F.col("id") * 101).alias("user_id"))
    found = orphans_by_bitmap(children, held, "user_id")
    assert found.filter("user_id BETWEEN 1 AND 99999").count() == 0 and found.count() == 1 + sum(101 * i >= 100_000 for i in range(1000))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "/users" not in plan and "/bits" in plan


def test_profiles_of_slices_add_up(spark):
    log = spark.range(60_000).select(
        F.col("id"), (F.col("id") % 1000).cast("string").alias("few"), F.when(F.col("id") % 4 > 0, F.col("id") / 3).alias("some"),
        F.lit(None).cast("decimal(20,2)").alias("none"), F.timestamp_micros(F.col("id") * 1_000_000).alias("at"),
        (F.col("id") % 2 == 0).alias("flag"), (F.col("id") % 3).cast("int").alias("slice"),
    )
    parts = [profile(log.filter(F.col("slice") == n).drop("slice")) for n in range(3)]
    assert all(p.count() == 6 for p in parts)
    found = {r.name: r for r in figures(united(*parts), (0.0, 0.5, 1.0)).collect()}
    whole = {r.name: r for r in figures(profile(log.drop("slice"))).collect()}
    assert {n: r[1:5] for n, r in found.items()} == {n: r[1:5] for n, r in whole.items()}
    assert found["id"][1:5] == (60_000, 0, 0.0, 59_999.0) and found["some"].n_nulls == 15_000
    assert found["none"][1:5] == (60_000, 60_000, None, None) and found["none"].quantiles is None
    assert found["few"].high == 3 and found["at"].high == 59_999 and found["flag"].low == 0
    for name, exact in (("id", 60_000), ("few", 1000), ("some", 45_000), ("flag", 2), ("none", 0)):
        assert abs(found[name].n_distinct - exact) <= 0.06 * exact
    assert found["id"].quantiles[0] == 0 and found["id"].quantiles[2] == 59_999
    assert abs(found["id"].quantiles[1] - 30_000) < 0.03 * 60_000
    by = profile(log, by=["slice"])
    assert by.count() == 18 and united(by, by=["slice"]).filter("name = 'id' AND n_rows = 20000").count() == 3
    empty = figures(profile(log.limit(0))).collect()
    assert len(empty) == 7 and all((r.n_rows, r.n_distinct, r.quantiles) == (0, 0, None) for r in empty)


def order(lsn, id, user):
    return (id, "c", id, user, "Anvil", Decimal("1.00"), T0, T0, False, lsn)


def user(lsn, id, op="c"):
    return (id, op, id, "Ann", "e", T0, T0, op == "d", lsn)


def test_states_as_of_the_position_that_all_logs_reached(spark):
    def log(spec, rows):
        return spark.createDataFrame(rows, spec.log_type().add("lsn", "long"))

    logs = {
        "orders": log(ORDERS, [order(2, 1, 1), order(5, 2, 2), order(9, 3, 3)]),
        "users": log(USERS, [user(1, 1), user(4, 2), user(6, 1, "d")]),  # lags: 3 is not here yet
    }
    tables = consistent_states(logs, [ORDERS, USERS])
    assert sorted(r.id for r in tables["orders"].collect()) == [1, 2] and [r.id for r in tables["users"].collect()] == [2]
    beats = spark.createDataFrame([("users", 20), ("users", 3)], "name string, lsn long")
    marks = {r.name: (r.reached, r.n_changes) for r in progress_marks(logs, beats).collect()}
    assert marks == {"orders": (9, 3), "users": (20, 3)}
    assert common_position(progress_marks(logs, beats)).first().lsn == 9
    assert consistent_states(logs, [ORDERS, USERS], beats)["orders"].count() == 3
    empty = logs | {"users": logs["users"].limit(0)}
    assert common_position(progress_marks(empty)).first().lsn is None
    assert all(t.count() == 0 for t in consistent_states(empty, [ORDERS, USERS]).values())


def test_topics_are_joined_while_they_arrive(spark, tmp_path):
    """Parents before, after and long after their children; two first rows of one; none; null keys."""
    topic, table, progress = (str(tmp_path / p) for p in ("topic", "table", "progress"))

    def record(spec, op, lsn, minute, key, image):
        value = b"{}" if image == "null" else f'{{"payload":{{"after":{image},"op":"{op}","ts_ms":0,"source":{{"lsn":{lsn}}}}}}}'.encode()
        return (f'{{"payload":{{"id":{key}}}}}'.encode(), value, spec.topic, 0, lsn, datetime(2024, 1, 1, 0, minute), 0)

    def order(lsn, minute, key, user, op="c"):
        return record(td.ORDERS, op, lsn, minute, key, f'{{"id":{key},"user_id":{user},"product_name":"a","amount":null,"created_at":0}}')

    def user(lsn, minute, key, name, op="c"):
        return record(td.USERS, op, lsn, minute, key, f'{{"id":{key},"full_name":"{name}","email":"e","created_at":0}}')

    def beat(minute):
        return [record(spec, "", 999, minute, 0, "null") for spec in (td.ORDERS, td.USERS)]

    batches = [
        [user(1, 0, 1, "Ann"), order(2, 1, 1, 1), order(3, 1, 2, 2), order(4, 1, 3, 3), order(5, 1, 4, "null"), order(6, 2, 1, 1, "u")],
        [user(7, 8, 2, "Bob"), user(8, 8, 1, "Ann again"), user(9, 9, 1, "Ann changed", "u")],
        beat(30),
        [user(10, 40, 3, "Cy"), order(11, 41, 5, 3), order(12, 41, 6, 9)],
        beat(59),
    ]
    for batch in batches:
        write_replay(spark.createDataFrame(batch, RECORD_TYPE), topic)
        records = (read_replay(spark, topic, topics=[s.topic]) for s in (td.ORDERS, td.USERS))
        rows = joined_logs(*records, td.ORDERS, td.USERS, "user_id", ["full_name"], patience="10 minutes", delay="0 seconds")
        append_to_table(rows, table, progress, trigger=ONCE).awaitTermination()
    rows = read_table(spark, table)
    found = with_parents(rows, td.ORDERS, "user_id")
    assert sorted((r.pk_id, r.lsn, r.full_name) for r in found.collect()) == [
        (1, 2, "Ann again"), (1, 6, "Ann again"), (2, 3, "Bob"), (5, 11, "Cy")
    ]
    assert sorted((r.pk_id, r.lsn) for r in orphaned(rows).collect()) == [(3, 4), (6, 12)]
    from rowtide.operators import decode
    log = decode(read_replay(spark, topic, streaming=False, topics=[td.USERS.topic]), td.USERS)
    assert [tuple(r) for r in late_parents(rows, log, "user_id", "id").collect()] == [(3, 1)]
