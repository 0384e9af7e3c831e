"""Changes from tables, records from changes, and tables from logs again."""

import json
from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowtide import ORDERS, TableSpec
from rowtide.operators import (
    compacted,
    connect_schema,
    count_rows,
    current_state,
    decode,
    delete_events,
    diff_events,
    diff_repeats,
    drop_redelivered,
    fold,
    in_commit_order,
    included,
    key_only,
    snapshot_events,
    state_as_of,
    state_for_sql,
    to_records,
    topic_name,
    update_events,
    with_offsets,
)
from rowtide.sources import in_topic_order, peek
from rowtide.specs import Field

TABLE = "id int, user_id int, product_name string, amount decimal(10,2), created_at timestamp_ntz"
T0 = datetime(2024, 1, 1)


def row(id, user_id=1, name="Anvil", amount="1.00"):
    return (id, user_id, name, Decimal(amount), T0)


def table(spark, rows):
    return spark.createDataFrame(rows, TABLE)


def at(text):
    return F.lit(text).cast("timestamp_ntz")


def as_set(df):
    return sorted(tuple(r) for r in df.collect())


def changes(df):
    out = df.select("op", "before.id", "after.id", "before.amount", "after.amount").collect()
    return sorted((tuple(r) for r in out), key=repr)


def test_diff(spark):
    old = table(spark, [row(1), row(2), row(3)])
    new = table(spark, [row(2), row(3, amount="2.00"), row(4)])
    got = changes(diff_events(old, new, ORDERS, at("2024-01-02"), F.lit(1)))
    one, two = Decimal("1.00"), Decimal("2.00")
    assert got == [("c", None, 4, None, one), ("d", 1, None, one, None), ("u", 3, 3, one, two)]


def test_diff_sees_changes_to_and_from_null(spark):
    old = table(spark, [(1, 1, None, Decimal(1), T0), (2, 1, "a", Decimal(1), T0), (3, 1, None, Decimal(1), T0)])
    new = table(spark, [(1, 1, "a", Decimal(1), T0), (2, 1, None, Decimal(1), T0), (3, 1, None, Decimal(1), T0)])
    assert [c[:2] for c in changes(diff_events(old, new, ORDERS, at("2024-01-02"), F.lit(1)))] == [("u", 1), ("u", 2)]


def test_keys_that_are_there_many_times_are_reported(spark):
    old = table(spark, [row(7)] * 500 + [row(1), row(2), (None, 1, "x", Decimal(1), T0)])
    new = table(spark, [row(7, amount="3.00")] * 500 + [row(1), row(2, amount="9.00"), row(3)] + [row(4)] * 2)
    got = changes(diff_events(old, new, ORDERS, at("2024-01-02"), F.lit(1)))
    assert [c[:3] for c in got] == [("c", None, 3), ("u", 2, 2)]
    found = sorted((tuple(r) for r in diff_repeats(old, new, ORDERS).collect()), key=repr)
    assert found == [(4, "new", 2), (7, "new", 500), (7, "old", 500), (None, "old", 1)]


def test_diff_is_a_join_whose_rows_are_not_reduced_before(spark):
    old, new = table(spark, [row(1)]), table(spark, [row(2)])
    plan = diff_events(old, new, ORDERS, at("2024-01-02"), F.lit(1))._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" in plan
    assert "SortAggregate" not in plan and "max(" not in plan


def test_changes_of_one_position_get_offsets_of_their_own(spark):
    t = table(spark, [row(i) for i in range(50)])
    shared = snapshot_events(t, ORDERS, F.col("created_at"), F.lit(7))
    records = to_records(with_offsets(shared, 4), ORDERS)
    assert sorted(r.offset for r in records.collect()) == list(range(50))
    later = with_offsets(shared.limit(1).unionByName(snapshot_events(t.limit(1), ORDERS, F.col("created_at"), F.lit(3))))
    assert [r.lsn for r in later.orderBy("offset").collect()] == [3, 7]


def test_records_without_tombstones_write_no_json_that_is_not_asked_for(spark):
    gone = snapshot_events(table(spark, [row(1)]), ORDERS, F.col("created_at"), F.col("id"))
    records = to_records(gone, ORDERS)
    plan = records.select("topic", "offset")._jdf.queryExecution().optimizedPlan().toString()
    assert "to_json" not in plan and "Generate" not in plan
    records.select("key", "value").createOrReplaceTempView("written")
    once = spark.sql("EXPLAIN EXTENDED SELECT * FROM written WHERE value IS NOT NULL").first()[0]
    optimized = once.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert "Filter" not in optimized  # the text is not written to see that it is there


def test_parser_reads_only_the_columns_asked_for(spark):
    gone = snapshot_events(table(spark, [row(1), row(2)]), ORDERS, F.col("created_at"), F.col("id"))
    records = to_records(gone, ORDERS)
    some = decode(records, ORDERS, columns=["amount"], extras=("lsn",))
    assert some.columns == ["pk_id", "op", "amount", "event_ts", "is_deleted", "lsn"]
    none = decode(records, ORDERS, columns=[])
    plan = none._jdf.queryExecution().optimizedPlan().toString()
    parsed = [line for line in plan.splitlines() if "from_json" in line][0]
    read = parsed.split("from_json")
    assert not any("product_name" in part for part in read[1:])
    assert [r.op for r in none.collect()] == ["r", "r"]
    with pytest.raises(ValueError):
        decode(records, ORDERS, columns=["colour"])


def test_wire_types(spark):
    spec = TableSpec("t", tuple(Field(n, w, not_null=False) for n, w in (
        ("id", "long"), ("d", "double"), ("f", "float"), ("b", "boolean"), ("day", "date"), ("s", "short"))))
    rows = [(1, 0.1 + 0.2, 1.5, True, date(1969, 12, 31), -7), (2, 1e300, -0.25, False, date(9999, 12, 31), 32767),
            (3, None, None, None, None, None)]
    kinds = "id long, d double, f float, b boolean, day date, s short"
    t = spark.createDataFrame(rows, kinds)
    events = snapshot_events(t, spec, at("2024-01-01"), F.col("id"))
    log = decode(to_records(events, spec), spec)
    assert log.schema.simpleString() == (
        "struct<pk_id:bigint,op:string,id:bigint,d:double,f:float,b:boolean,day:date,s:smallint,"
        "event_ts:timestamp,is_deleted:boolean>"
    )
    assert sorted(map(tuple, log.select(*spec.columns).collect())) == rows
    assert '"io.debezium.time.Date"' in connect_schema(spec)


def test_update_and_delete_by_predicate(spark):
    t = table(spark, [row(1), row(2)])
    up = update_events(t, ORDERS, F.col("id") == 2, {"amount": F.col("amount") + 1}, F.col("created_at"), F.lit(1))
    assert changes(up) == [("u", 2, 2, Decimal("1.00"), Decimal("2.00"))]
    gone = delete_events(t, ORDERS, F.col("id") == 1, F.col("created_at"), F.lit(1))
    assert changes(gone) == [("d", 1, None, Decimal("1.00"), None)]
    with pytest.raises(ValueError):
        update_events(t, ORDERS, F.lit(True), {"colour": F.lit(1)}, F.lit(None), F.lit(1))


def history(spark, old, new):
    """A snapshot of the old version and the changes to the new one, as a log."""
    first = snapshot_events(old, ORDERS, at("2024-01-01 00:00:01"), F.lit(1))
    second = diff_events(old, new, ORDERS, at("2024-01-02"), F.lit(2))
    return decode(to_records(first.unionByName(second), ORDERS), ORDERS, extras=("lsn",))


rows = st.dictionaries(
    st.integers(1, 30),
    st.tuples(st.integers(1, 5), st.sampled_from(["a", "b", None]), st.integers(-10**9, 10**9)),
    max_size=20,
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows, rows)
def test_log_of_two_versions_leads_to_the_second(spark, old, new):
    old, new = (
        table(spark, [(k, u, n, Decimal(a).scaleb(-2), T0) for k, (u, n, a) in v.items()])
        for v in (old, new)
    )
    log = history(spark, old, new)
    zoneless = F.col("created_at").cast("timestamp_ntz").alias("created_at")
    state = current_state(log, ORDERS).withColumn("created_at", zoneless)
    key = lambda r: r[0]
    assert sorted(map(tuple, state.collect()), key=key) == sorted(map(tuple, new.collect()), key=key)
    past = state_as_of(log, ORDERS, datetime(2024, 1, 1, 12)).withColumn("created_at", zoneless)
    assert sorted(map(tuple, past.collect()), key=key) == sorted(map(tuple, old.collect()), key=key)
    assert count_rows(log, ORDERS).first()[0] == new.count()


LOG = "pk_id int, op string, id int, user_id int, product_name string, amount decimal(20,2), created_at timestamp, event_ts timestamp, is_deleted boolean, lsn long"


def entry(pk, op, lsn, name="Anvil", id=None, ts=T0):
    return (pk, op, pk if id is None else id, 1, name, Decimal(1), T0, ts, op == "d" if op else None, lsn)


def names(df):
    return sorted((r.id, r.product_name) for r in df.collect())


def test_state_goes_by_log_position_not_by_clock(spark):
    log = spark.createDataFrame(
        [entry(1, "c", 1, "old", ts=datetime(2024, 1, 3)), entry(1, "u", 2, "new", ts=datetime(2024, 1, 2))], LOG
    )
    assert names(current_state(log, ORDERS)) == [(1, "new")]
    assert names(current_state(log, ORDERS, order_by=("event_ts",))) == [(1, "old")]


def test_state_of_deletes_and_of_rows_inserted_again(spark):
    stub = (1, "d", 1, None, None, None, None, T0, True, 2)
    log = spark.createDataFrame([entry(1, "c", 1), stub, entry(2, "c", 3), (2, *stub[1:2], 2, *stub[3:9], 4), entry(2, "c", 5, "again")], LOG)
    assert names(current_state(log, ORDERS)) == [(2, "again")]


def test_state_leaves_out_what_speaks_of_no_row(spark):
    log = spark.createDataFrame(
        [entry(1, "c", 1), (None, "t", None, None, None, None, None, T0, False, 2),
         (5, None, None, None, None, None, None, T0, None, 3), entry(None, "c", 4, id=9)], LOG
    )
    assert names(current_state(log.filter("op IS NULL OR op <> 't'"), ORDERS)) == [(1, "Anvil"), (9, "Anvil")]


def test_nothing_from_before_a_truncate_is_left(spark):
    cut = (None, "t", None, None, None, None, None, T0, False, 3)
    log = spark.createDataFrame([entry(1, "c", 1), entry(2, "c", 2), cut, entry(3, "c", 4)], LOG)
    assert names(current_state(log, ORDERS)) == names(state_for_sql(log, ORDERS)) == [(3, "Anvil")]
    assert count_rows(log, ORDERS, order_by=("lsn",)).first()[0] == 1
    early = log.filter("lsn < 3")
    assert names(current_state(early, ORDERS)) == [(1, "Anvil"), (2, "Anvil")]
    folded = fold(compacted(early, ORDERS), log.filter("lsn >= 3"), ORDERS)
    assert names(current_state(folded, ORDERS)) == [(3, "Anvil")]
    # A change from before the truncate that comes late stays out, too.
    again = fold(folded, spark.createDataFrame([entry(9, "c", 2)], LOG), ORDERS)
    assert names(current_state(again, ORDERS)) == [(3, "Anvil")]


def test_a_fold_reads_the_earlier_fold_and_the_slice(spark, tmp_path):
    rows = [entry(i % 40, "u" if i >= 40 else "c", i, f"v{i}") for i in range(200)]
    rows += [entry(5, "d", 300), entry(6, "d", 150), entry(6, "c", 301, "back")]
    log = spark.createDataFrame(rows, LOG)
    log.filter("lsn < 120").write.parquet(str(tmp_path / "old"))
    log.filter("lsn >= 100").write.parquet(str(tmp_path / "slice"))  # some of it overlaps
    compacted(spark.read.parquet(str(tmp_path / "old")), ORDERS).write.parquet(str(tmp_path / "fold"))
    earlier, later = (spark.read.parquet(str(tmp_path / n)) for n in ("fold", "slice"))
    folded = fold(earlier, later, ORDERS)
    assert names(current_state(folded, ORDERS)) == names(current_state(log, ORDERS))
    assert folded.columns == log.columns and folded.count() == 40
    assert not any("/old/" in f for f in folded.inputFiles())


def test_state_needs_the_position_or_another_order(spark):
    log = spark.createDataFrame([entry(1, "c", 1), entry(2, "c", 2)], LOG)
    bare = log.drop("lsn")
    for state in (current_state, state_for_sql, count_rows, compacted):
        with pytest.raises(ValueError, match="lsn"):
            state(bare, ORDERS)
    assert names(current_state(bare, ORDERS, order_by=("event_ts",))) == [(1, "Anvil"), (2, "Anvil")]
    assert count_rows(log, ORDERS, order_by=("lsn",)).first()[0] == 2


@pytest.mark.parametrize(
    "rows",
    [
        [entry(1, "c", 10, "old"), entry(1, "u", None, "new")],
        [(None, "t", None, None, None, None, None, T0, False, 5), entry(1, "c", None)],
        [entry(1, "c", None, "first"), entry(1, "u", None, "second")],
        [(None, "t", None, None, None, None, None, T0, False, None), entry(1, "c", 3)],
    ],
)
def test_changes_without_position_are_refused(spark, rows):
    log = spark.createDataFrame(rows, LOG)
    wide = log.withColumns({"offset": F.lit(1).cast("long"), "position": F.lit("f.1")})
    for state in (current_state, state_for_sql, count_rows, compacted, lambda log, spec: fold(log.limit(0), log, spec)):
        for given in (log, wide):
            with pytest.raises(Exception, match="without lsn"):
                state(given, ORDERS).collect()
    # What says nothing of a row needs no place.
    other = spark.createDataFrame([entry(1, "c", 1), entry(2, "x", None), entry(None, "c", None, id=None)], LOG)
    assert names(current_state(other, ORDERS)) == [(1, "Anvil")]


def test_another_order_must_be_whole(spark):
    log = spark.createDataFrame([entry(1, "c", None, "old"), entry(1, "u", None, "new", ts=datetime(2024, 1, 2))], LOG)
    assert names(current_state(log, ORDERS, order_by=("event_ts",))) == [(1, "new")]
    holes = log.withColumn("event_ts", F.when(F.col("op") == "u", F.col("event_ts")))
    with pytest.raises(Exception, match="without event_ts"):
        current_state(holes, ORDERS, order_by=("event_ts",)).collect()


def test_textual_positions_go_by_their_numbers(spark):
    places = ["bin.000009:154", "bin.000010:4", "bin.10:30", "bin.10:0200", "bin.10:200x", "bin.11", "cin.1"]
    log = spark.createDataFrame([entry(1, "u", None, p) for p in reversed(places)], LOG).withColumn("position", F.col("product_name"))
    by_number, by_text = replace(ORDERS, position="natural"), replace(ORDERS, position="text")
    for n in range(1, len(places) + 1):
        some = log.filter(F.col("product_name").isin(places[:n]))
        assert names(current_state(some, by_number)) == names(state_for_sql(some, by_number)) == [(1, places[n - 1])]
        assert names(current_state(some, ORDERS, order_by=("position",))) == [(1, places[n - 1])]
    assert names(current_state(log.filter("product_name < 'bin.2'"), by_text)) == [(1, "bin.11")]
    with pytest.raises(Exception, match="without position"):
        current_state(log.withColumn("position", F.lit(None).cast("string")), by_number).collect()
    with pytest.raises(ValueError, match="position"):
        replace(ORDERS, position="hex")


def test_commit_order(spark):
    t = table(spark, [row(i) for i in range(100, 0, -1)])
    changes = in_commit_order(snapshot_events(t, ORDERS, F.col("created_at"), F.col("id")), 4)
    records = to_records(changes, ORDERS).withColumn("task", F.spark_partition_id())
    runs = [(r.task, r.offset) for r in records.collect()]
    assert [o for _, o in runs] == list(range(1, 101)) and len({t for t, _ in runs}) == 4


def test_state_of_a_hot_key(spark):
    """A third of all changes to one key: reduced in each task before the shuffle."""
    hot = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).cast("int").alias("pk_id"),
        F.col("id").alias("lsn"),
    )
    log = hot.select(
        "pk_id", F.lit("u").alias("op"), F.col("pk_id").alias("id"), F.lit(1).alias("user_id"),
        F.col("lsn").cast("string").alias("product_name"), F.lit(Decimal(1)).cast("decimal(20,2)").alias("amount"),
        F.lit(T0).alias("created_at"), F.lit(T0).alias("event_ts"), F.lit(False).alias("is_deleted"), "lsn",
    )
    state = current_state(log, ORDERS)
    assert state.count() == 4001
    assert state.filter("id = 0").first().product_name == "5997"
    plan = state._jdf.queryExecution().executedPlan().toString()
    reduced = plan.split("Subquery")[0]
    assert "partial_max_by" in plan and reduced.count("Exchange hashpartitioning") <= 1


def test_state_reads_only_what_is_asked_for(spark, tmp_path):
    path = str(tmp_path / "log")
    spark.createDataFrame([entry(1, "c", 1)], LOG).write.parquet(path)
    log = spark.read.parquet(path)
    plan = current_state(log, ORDERS, columns=["id"])._jdf.queryExecution().executedPlan().toString()
    assert "product_name" not in plan and "amount" not in plan
    counted = count_rows(log, ORDERS, order_by=("lsn",))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in counted


def test_state_for_sql(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = [entry(1, "c", 1, "old"), entry(1, "u", 2, "new"), entry(2, "c", 3), entry(2, "d", 4),
            entry(3, "c", 5), (None, "x", None, None, None, None, None, T0, False, 9)]
    spark.createDataFrame(rows, LOG).write.parquet(path)
    log = spark.read.parquet(path)
    assert names(state_for_sql(log, ORDERS)) == names(current_state(log, ORDERS)) == [(1, "new"), (3, "Anvil")]
    plan = state_for_sql(log, ORDERS).groupBy().count()._jdf.queryExecution().executedPlan().toString()
    assert "product_name" not in plan  # not asked for, not read
    assert "row_number(), 1, Partial" in plan  # reduced before the shuffle


def test_redelivered_changes_count_once(spark):
    log = spark.createDataFrame([entry(1, "c", 1), entry(1, "c", 1), entry(1, "u", 2), entry(2, "c", 1)], LOG)
    assert drop_redelivered(log, ORDERS).count() == 3


def test_changes_without_position_are_no_repeats(spark):
    log = spark.createDataFrame([entry(1, "u", None, n) for n in "abc"] + [entry(1, "u", 4, "d")] * 2, LOG)
    assert [n for _, n in names(drop_redelivered(log, ORDERS))] == ["a", "b", "c", "d"]
    placed = log.withColumns({"partition": F.lit(0), "offset": F.when(F.col("product_name") == "c", 9).otherwise(8)})
    assert [n for _, n in names(drop_redelivered(placed, ORDERS))][1:] == ["c", "d"]
    text = log.withColumn("position", F.concat(F.lit("file.3:"), "product_name"))
    twice = text.unionByName(text)
    assert [n for _, n in names(drop_redelivered(twice, ORDERS))] == ["a", "b", "c", "d"]


def test_records(spark):
    t = table(spark, [row(1), row(2)])
    gone = delete_events(t, ORDERS, F.lit(True), F.col("created_at"), F.col("id"))
    plain = to_records(gone, ORDERS).collect()
    assert [(r.topic, r.partition, r.offset, r.timestampType) for r in plain] == [
        ("appdb.public.orders", 0, 1, 0), ("appdb.public.orders", 0, 2, 0)
    ]
    value = json.loads(bytes(plain[0].value))
    assert value["schema"] is None
    assert value["payload"]["after"] is None and value["payload"]["op"] == "d"
    assert value["payload"]["before"] == {
        "id": 1, "user_id": 1, "product_name": "Anvil", "amount": "ZA==", "created_at": 1704067200000000
    }
    both = to_records(gone, ORDERS, tombstones=True).orderBy("offset").collect()
    assert [(r.offset, r.value is None) for r in both] == [(2, False), (3, True), (4, False), (5, True)]
    assert len({r.partition for r in to_records(gone, ORDERS, partitions=64).collect()}) == 2


def test_records_with_connector_schema(spark):
    gone = delete_events(table(spark, [row(1)]), ORDERS, F.lit(True), F.col("created_at"), F.col("id"))
    value = json.loads(bytes(to_records(gone, ORDERS, schema=connect_schema(ORDERS)).first().value))
    assert value["schema"]["name"] == "appdb.public.orders.Envelope"
    assert value["payload"]["op"] == "d"


def test_zoneless_times_do_not_depend_on_the_session(spark):
    """Half past two does not exist on this night in this zone, and is kept all the same."""
    t = spark.createDataFrame([(1, 1, "a", Decimal(1), datetime(2024, 3, 31, 2, 30))], TABLE)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Warsaw")
    try:
        gone = delete_events(t, ORDERS, F.lit(True), F.col("created_at"), F.col("id"))
        record = to_records(gone, ORDERS).select("value", F.unix_micros("timestamp")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    payload = json.loads(bytes(record.value))["payload"]
    assert payload["before"]["created_at"] == 1711852200000000 == record[1]
    assert payload["ts_ms"] == 1711852200000


def test_key_only(spark):
    t = table(spark, [row(3)])
    got = t.select(key_only(t, ORDERS).alias("k")).first().k
    assert (got.id, got.user_id, got.product_name) == (3, None, None)


def test_included(spark):
    df = spark.createDataFrame(
        [("public", "users"), ("publicx", "t"), ("audit", "public"), ("PUBLIC", "users")], "s string, t string"
    )
    def taken(*lists):
        return [r[0] for r in df.select(included(F.col("s"), F.col("t"), *lists)).collect()]
    assert taken() == [True] * 4
    assert taken(None, "public.*") == [True, True, False, True]
    assert taken("public", "public.*") == [True, False, False, True]
    assert taken(None, r"public\.users, audit\..*") == [True, False, True, True]
    assert taken("pub") == [False] * 4


def test_topics(spark):
    df = spark.range(1).select(topic_name(F.lit("p"), F.lit("s"), F.lit("t")))
    assert df.first()[0] == "p.s.t"


def test_topic_order_and_peek(spark):
    t = table(spark, [row(i) for i in range(100, 0, -1)])
    records = to_records(snapshot_events(t, ORDERS, F.col("created_at"), F.col("id")), ORDERS)
    ordered = in_topic_order(records, 4).withColumn("task", F.spark_partition_id())
    runs = [(r.task, r.offset) for r in ordered.collect()]
    assert [o for _, o in runs] == list(range(1, 101))
    assert len({t for t, _ in runs}) == 4  # one topic, and still many tasks
    assert [r.offset for r in peek(records, ORDERS.topic, 5).collect()] == [1, 2, 3, 4, 5]
    assert peek(records, "other", 5).count() == 0
