"""Versions of a table against the log, and interval joins against all pairs."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rowtide import ORDERS
from rowtide.operators import at_position, at_time, current_state, interval_join, state_as_of, versions
from rowtide.operators.intervals import dated
from rowtide.streaming import History

T0 = datetime(2024, 1, 1)


def change(op, lsn, key, minute, name="Anvil"):
    at = T0 + timedelta(minutes=minute)
    if op == "t":
        return (None, "t", None, None, None, None, None, at, False, lsn)
    return (key, op, key, 1, name, Decimal("1.00"), T0, at, op == "d", lsn)


def log(spark, rows):
    return spark.createDataFrame(rows, ORDERS.log_type().add("lsn", "long"))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def some(seed, n=120, truncates=2):
    """Changes whose times do not always rise with their positions."""
    rng = random.Random(seed)
    cuts = set(rng.sample(range(1, n), truncates))
    return [
        change("t" if lsn in cuts else rng.choice("cuud"), lsn, rng.choice([1, 1, 1, *range(2, 9)]), lsn + rng.choice([0, 0, 0, -9, 15]), f"v{lsn}")
        for lsn in range(1, n)
    ]


@pytest.mark.parametrize("slot,truncates", [(10**6, 2), (7, 0), (3, 2)])
def test_versions_agree_with_the_log_at_every_moment(spark, slot, truncates):
    changes = log(spark, some(slot, truncates=truncates)).cache()
    held = versions(changes, ORDERS, slot=slot).cache()
    assert held.count() == 119
    for minute in (-20, 0, 5, 33, 60, 61, 90, 118, 500):
        at = F.lit(T0 + timedelta(minutes=minute)).cast("timestamp")
        assert rows(at_time(held, ORDERS, at)) == rows(state_as_of(changes, ORDERS, at)), minute
    for lsn in (0, 1, 40, 77, 119):
        expected = current_state(changes.filter(F.col("lsn") <= lsn), ORDERS)
        assert rows(at_position(held, ORDERS, F.lit(lsn))) == rows(expected), lsn


def test_a_history_extended_by_slices_is_that_of_the_whole_log(spark, tmp_path):
    changes = some(9)
    random.Random(1).shuffle(changes)
    slices = [changes[:50], changes[40:80], [], changes[80:]]  # they overlap, and nothing comes in order
    history = History(spark, str(tmp_path), ORDERS, buckets=4, slot=9)
    for number, slice_ in enumerate(slices):
        for _ in range(2 if number == 1 else 1):
            history.apply(number, log(spark, slice_))
        if number == 1:
            history.fold()
    whole = versions(log(spark, changes), ORDERS)
    assert rows(history.versions().select(*whole.columns)) == rows(whole)
    history.fold()
    assert rows(history.versions().select(*whole.columns)) == rows(whole)


def test_after_a_fold_the_past_is_a_filter(spark, tmp_path):
    history = History(spark, str(tmp_path), ORDERS, buckets=4)
    history.apply(0, log(spark, some(3)))
    history.fold()
    then = history.at_time(F.lit(T0 + timedelta(minutes=50)).cast("timestamp"))
    plan = then._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan and then.count()


def test_a_small_slice_reads_and_writes_its_keys(spark, tmp_path):
    history = History(spark, str(tmp_path), ORDERS, buckets=64)
    history.apply(0, log(spark, [change("c", i, i, i) for i in range(1, 300)]))
    history.apply(1, log(spark, [change("u", 1000, 7, 1000)]))
    written = history.rows.read(1).filter("batch_id = 1")
    assert rows(written.select("pk_id", "valid_from", "valid_to")) == [(7, 1000, None), (7, 7, 1000)]
    assert history.rows.touched([F.col("pk_id")], written) and written.select("bucket").distinct().count() == 1


def test_odd_logs(spark, tmp_path):
    history = History(spark, str(tmp_path), ORDERS)
    history.apply(0, log(spark, []))
    assert history.versions().count() == 0 and history.at_position(F.lit(5)).count() == 0
    with pytest.raises(Exception, match="without lsn"):
        versions(log(spark, [change("c", None, 1, 0)]), ORDERS).collect()
    keyless = log(spark, [(None, "c", 5, 1, "a", Decimal(1), T0, T0, False, 1), (None, "c", None, 1, "b", Decimal(1), T0, T0, False, 2), (3, "x", 3, 1, "c", Decimal(1), T0, T0, False, 3)])
    assert [r.pk_id for r in versions(keyless, ORDERS).collect()] == [5]


@pytest.mark.parametrize("seed", [1, 2])
def test_interval_join_equals_all_pairs(spark, seed):
    rng = random.Random(seed)
    minute = lambda n: T0 + timedelta(minutes=n)
    points = [(rng.choice([1, 1, 2, None]), i, minute(rng.randint(-500, 5000))) for i in range(150)] + [(1, 999, None)]
    intervals = []
    for i in range(120):
        start = rng.randint(-800, 5000)
        end = rng.choice([None, start, start + 1, start + rng.randint(1, 60), start + rng.randint(1, 4000)])
        intervals.append((rng.choice([1, 2, 3, None]), i, minute(start), None if end is None else minute(end)))
    intervals.append((1, 999, None, None))
    p = spark.createDataFrame(points, "k int, p int, at timestamp")
    v = spark.createDataFrame(intervals, "k int, v int, start timestamp, end timestamp")
    got = interval_join(p, v, ["k"], "at", "start", "end", resolution="10 minutes")
    assert got.columns == ["k", "p", "at", "v", "start", "end"]
    expected = sorted(
        (pk, vi) for k, pk, at in points for j, vi, start, end in intervals
        if k is not None and k == j and at and start and start <= at and (end is None or at < end)
    )
    assert sorted((r.p, r.v) for r in got.collect()) == expected and expected
    assert interval_join(p.limit(0), v, ["k"], "at", "start", "end").count() == 0
    assert interval_join(p, v.limit(0), ["k"], "at", "start", "end").count() == 0


def test_long_intervals_meet_no_pairs_in_vain(spark):
    """Open intervals of one hot key: what the blocks bring together is mostly what belongs together."""
    n = 1000
    at = F.timestamp_micros(F.col("id") * 60_000_000)
    points = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("p"), at.alias("at"))
    spans = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("v"), at.alias("start"), F.timestamp_micros(F.col("id") * 60_000_000 + 120_000_000).alias("end"))
    assert interval_join(points, spans, ["k"], "at", "start", "end", resolution="1 minute").count() == 2 * n - 1


def test_an_interval_join_broadcasts_neither_side(spark):
    at = F.timestamp_micros(F.col("id") * 60_000_000)
    points = spark.range(3).select(F.lit(1).alias("k"), F.col("id").alias("p"), at.alias("at"))
    spans = spark.range(3).select(F.lit(1).alias("k"), F.col("id").alias("v"), at.alias("start"), F.lit(None).cast("timestamp").alias("end"))
    found = interval_join(points, spans, ["k"], "at", "start", "end")
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString() and found.count() == 6


@pytest.mark.parametrize("slot", [10**6, 2])
def test_the_last_form_of_a_version_counts(spark, slot):
    """Forms of several batches are told apart where the rows are sorted, without a shuffle of their own."""
    rows_ = [(1, n, T0 + timedelta(minutes=n), False, batch) for n in (1, 2, 5, 7) for batch in (0, 3, -1)] + [(None, 6, T0 + timedelta(minutes=6), True, b) for b in (2, 4)]
    changes = spark.createDataFrame(rows_, "pk int, valid_from long, from_ts timestamp, cut boolean, batch_id long")
    found = dated(changes, ["pk"], slot=slot, prefer="batch_id").select("pk", "valid_from", "valid_to", "batch_id")
    assert rows(found) == sorted([(1, 1, 2, 3), (1, 2, 5, 3), (1, 5, 6, 3), (1, 7, None, 3), (None, 6, None, 4)], key=repr)
