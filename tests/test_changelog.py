"""Decoding by hand-made records: schemas, shapes and edges."""

import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rowtide import ORDERS, USERS, TableSpec
from rowtide.operators import connect_schema, decode, judged, log_of, rejects, rejects_of
from rowtide.sources import RECORD_TYPE

IMAGE = {"id": 1, "user_id": 2, "product_name": "Anvil", "amount": "MDk=", "created_at": 1700000000123456}
STUB = {"id": 1, "user_id": None, "product_name": None, "amount": None, "created_at": None}
PAYLOAD = {"before": None, "after": IMAGE, "op": "c", "ts_ms": 1700000001500, "source": {"lsn": 7}}


def wrapped(schema=None, **parts):
    return json.dumps({"schema": schema, "payload": {**PAYLOAD, **parts}})


def without(*names):
    return json.dumps({"schema": None, "payload": {k: v for k, v in PAYLOAD.items() if k not in names}})


def image(**parts):
    return wrapped(after={**IMAGE, **parts})


KEY = '{"schema":null,"payload":{"id":1}}'


def records(spark, values, keys=None, topic=ORDERS.topic):
    rows = [
        (
            None if k is None else bytearray(k, "utf-8"),
            None if v is None else bytearray(v, "utf-8"),
            topic, 0, i, datetime(2024, 1, 1), 0,
        )
        for i, (v, k) in enumerate(zip(values, keys or [KEY] * len(values)))
    ]
    return spark.createDataFrame(rows, RECORD_TYPE)


def log(spark, *values, keys=None, spec=ORDERS, **how):
    out = decode(records(spark, values, keys), spec, extras=("offset",), **how).collect()
    return {r.offset: r for r in out}


def reasons(spark, *values, keys=None, **how):
    found = rejects(records(spark, values, keys), ORDERS, **how).collect()
    return {r.offset: r.reason for r in found}


def test_log_schema(spark):
    for spec, expected in (
        (ORDERS, "pk_id int, op string, id int, user_id int, product_name string, "
                 "amount decimal(20,2), created_at timestamp, event_ts timestamp, is_deleted boolean"),
        (USERS, "pk_id int, op string, id int, full_name string, email string, "
                "created_at timestamp, event_ts timestamp, is_deleted boolean"),
    ):
        got = decode(records(spark, []), spec).schema
        assert ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in got) == expected
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in spec.log_type()]


def test_valid_record(spark):
    row = log(spark, wrapped())[0]
    assert (row.pk_id, row.op, row.id, row.user_id, row.product_name) == (1, "c", 1, 2, "Anvil")
    assert row.amount == Decimal("123.45")
    assert row.is_deleted is False
    exact = decode(records(spark, [wrapped()]), ORDERS, precision="micro")
    times = [
        df.select(F.unix_micros("created_at"), F.unix_micros("event_ts")).first()
        for df in (decode(records(spark, [wrapped()]), ORDERS), exact)
    ]
    assert [tuple(t) for t in times] == [
        (1700000000000000, 1700000001500000), (1700000000123456, 1700000001500000)
    ]


def test_connector_schema_is_skipped(spark):
    value = wrapped(schema=json.loads(connect_schema(ORDERS)))
    assert log(spark, value)[0].amount == Decimal("123.45")


def test_delete_takes_the_row_before(spark):
    rows = log(
        spark,
        wrapped(op="d", before=IMAGE, after=None),
        wrapped(op="d", before=STUB, after=None),
    )
    assert (rows[0].product_name, rows[0].is_deleted) == ("Anvil", True)
    assert (rows[1].id, rows[1].product_name, rows[1].amount, rows[1].is_deleted) == (1, None, None, True)


def test_plain_envelope(spark):
    plain = json.dumps(PAYLOAD)
    keys = ['{"id":1}', KEY]
    assert log(spark, plain, plain, keys=keys)[0].pk_id == 1
    assert log(spark, plain, strict_wrapped=True) == {}
    assert reasons(spark, plain, strict_wrapped=True) == {0: "no_envelope"}


def test_plain_and_wrapped_agree(spark):
    rows = log(spark, wrapped(), json.dumps(PAYLOAD), keys=[KEY, '{"id":1}'])
    assert rows[0][:-1] == rows[1][:-1]


DROPPED = {
    "malformed": "{oops",
    "cut": wrapped()[:50],
    "empty": "",
    "json null": "null",
    "array": "[]",
    "null payload": '{"schema":null,"payload":null}',
    "other object": '{"hello":1}',
    "tombstone": None,
}


@pytest.mark.parametrize("strict", [True, False])
def test_values_without_envelope_are_dropped(spark, strict):
    assert log(spark, *DROPPED.values(), strict_wrapped=strict) == {}
    found = reasons(spark, *DROPPED.values(), strict_wrapped=strict)
    assert len(found) == len(DROPPED)
    by_name = dict(zip(DROPPED, (found[i] for i in range(len(DROPPED)))))
    assert by_name["malformed"] == by_name["cut"] == by_name["empty"] == "malformed"
    assert by_name["null payload"] == "empty_payload"
    assert by_name["other object"] == "no_envelope"
    assert by_name["tombstone"] == "tombstone"


def test_truncate_keeps_a_row_of_nulls(spark):
    row = log(spark, wrapped(op="t", after=None))[0]
    assert (row.op, row.id, row.product_name, row.is_deleted) == ("t", None, None, False)
    assert reasons(spark, wrapped(op="t", after=None)) == {0: "truncate"}


def test_missing_op_keeps_a_row_without_image(spark):
    row = log(spark, without("op"))[0]
    assert (row.pk_id, row.op, row.id, row.is_deleted) == (1, None, None, None)
    assert reasons(spark, without("op")) == {0: "no_op"}


def test_unknown_op(spark):
    row = log(spark, wrapped(op="m"))[0]
    assert (row.op, row.id, row.is_deleted) == ("m", None, False)
    assert reasons(spark, wrapped(op="m")) == {0: "unknown_op"}


def test_missing_image(spark):
    assert log(spark, wrapped(after=None))[0].id is None
    assert reasons(spark, wrapped(after=None)) == {0: "no_image"}


def test_bad_fields_are_null_and_the_rest_is_kept(spark):
    values = [
        image(amount="*not base64*"), image(id="x"), image(id=3000000000), image(created_at=1.5),
    ]
    rows = log(spark, *values)
    assert [rows[i].product_name for i in range(4)] == ["Anvil"] * 4
    assert rows[0].amount is None and rows[0].id == 1
    assert rows[1].id is None and rows[2].id is None
    assert rows[3].created_at is None
    assert reasons(spark, *values) == dict.fromkeys(range(4), "bad_field")


def test_unknown_field_is_ignored(spark):
    assert log(spark, image(colour="red"))[0].product_name == "Anvil"
    assert reasons(spark, image(colour="red")) == {}


def test_null_key_is_kept(spark):
    row = log(spark, wrapped(), keys=[None])[0]
    assert (row.pk_id, row.id) == (None, 1)
    assert reasons(spark, wrapped(), keys=[None]) == {0: "no_key"}


def test_overflow_is_rejected(spark):
    import base64
    big = base64.b64encode((10**20).to_bytes(9, "big", signed=True)).decode()
    assert log(spark, image(amount=big), on_overflow="null")[0].amount is None
    assert reasons(spark, image(amount=big)) == {0: "decimal_overflow"}


def test_nulls_where_the_table_has_none(spark):
    values = [image(product_name=None), wrapped(op="d", before=STUB, after=None), image(amount=None)]
    assert reasons(spark, *values) == {0: "null_field", 2: "null_field"}


def test_log_and_rejects_are_one_reading(spark):
    values = [wrapped(), "{oops", wrapped(op="t", after=None), None, image(id="x")]
    rows = judged(records(spark, values), ORDERS, extras=("lsn",))
    parts = {r.offset: (r.part, r.reason, r.json) for r in rows.collect()}
    assert parts == {
        0: ("accepted", None, None), 1: ("rejected", "malformed", "{oops"),
        2: ("flagged", "truncate", values[2]), 3: ("rejected", "tombstone", None), 4: ("flagged", "bad_field", values[4]),
    }
    assert rejects_of(rows).count() == 4
    log = log_of(rows, ORDERS)
    assert log.columns == [*ORDERS.log_type().fieldNames(), "lsn"]
    plain = decode(records(spark, values), ORDERS, extras=("lsn",), on_overflow="null")
    assert sorted(map(repr, log.collect())) == sorted(map(repr, plain.collect()))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 2 and "Exchange" not in plan
    # Filters on the parts hold no copy of the decodes.
    decodes = []
    for df in (rows, rejects_of(rows), log, rejects(records(spark, values), ORDERS)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        decodes.append(plan.count("conv("))
        assert all(len(line) < 3000 for line in plan.splitlines() if "Filter" in line)
    assert len(set(decodes)) == 1 and decodes[0]


def test_positions_that_are_no_numbers_are_kept_as_text(spark):
    values = [wrapped(source={"lsn": "binlog.3:77"}), wrapped()]
    rows = decode(records(spark, values), ORDERS, extras=("lsn", "position")).collect()
    assert [(r.lsn, r.position) for r in rows] == [(None, "binlog.3:77"), (7, "7")]


def test_rejects_keep_whole_texts(spark):
    long = "x" * 100_000
    row = rejects(records(spark, [long]), ORDERS).first()
    assert (row.json, row.key_str, row.topic, row.partition) == (long, KEY, ORDERS.topic, 0)


def test_extras(spark):
    df = decode(records(spark, [wrapped()]), ORDERS, extras=("lsn", "source", "topic", "offset"))
    row = df.first()
    assert (row.lsn, row.source, row.topic, row.offset) == (7, {"lsn": "7"}, ORDERS.topic, 0)
    quoted = wrapped(source={"lsn": "8"})
    assert decode(records(spark, [quoted]), ORDERS, extras=("lsn",)).first().lsn == 8
    none = wrapped(source=None)
    assert decode(records(spark, [none]), ORDERS, extras=("lsn",)).first().lsn is None
    with pytest.raises(ValueError):
        decode(records(spark, []), ORDERS, extras=("colour",))


def test_each_value_is_parsed_once(spark):
    plan = decode(records(spark, [wrapped()]), ORDERS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 2  # one key, one envelope
    assert "Python" not in plan


def test_decode_does_not_shuffle(spark):
    plan = decode(records(spark, [wrapped()]), ORDERS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_spec_from_dict_and_file(tmp_path):
    assert TableSpec.from_dict(ORDERS.to_dict()) == ORDERS
    path = tmp_path / "orders.json"
    path.write_text(json.dumps(ORDERS.to_dict()))
    assert TableSpec.from_file(str(path)) == ORDERS
    assert ORDERS.topic == "appdb.public.orders"
    with pytest.raises(ValueError):
        TableSpec.from_dict({"name": "t", "fields": [{"name": "a", "wire": "colour"}], "key": ["a"]})
    with pytest.raises(ValueError):
        TableSpec.from_dict({"name": "t", "fields": [{"name": "a", "wire": "int"}], "key": ["b"]})
