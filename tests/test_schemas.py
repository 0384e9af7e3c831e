"""Specifications read from messages."""

import base64
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from rowtide import ORDERS, USERS
from rowtide.operators import connect_schema, decode
from rowtide.sources import RECORD_TYPE, decode_inferred, schema_versions, spec_of, widened
from rowtide.sources.schemas import first_seen
from rowtide.specs import Field, TableSpec

TOPIC = "appdb.public.things"


def described(*fields):
    image = {"type": "struct", "fields": list(fields)}
    return {"type": "struct", "fields": [{**image, "field": "before"}, {**image, "field": "after"}]}


def column(name, kind="int32", meaning=None, optional=True, **more):
    return {"field": name, "type": kind, "optional": optional, **({"name": meaning} if meaning else {}), **more}


DECIMAL = "org.apache.kafka.connect.data.Decimal"


def amount(scale, precision=None):
    given = {"scale": str(scale)} | ({"connect.decimal.precision": str(precision)} if precision else {})
    return column("amount", "bytes", DECIMAL, parameters=given)


def message(schema, after, lsn, op="c", key="id", before=None, topic=TOPIC):
    def text(schema, payload):
        return json.dumps({"schema": schema, "payload": payload}, separators=(",", ":")).encode()

    payload = {"before": before, "after": after, "op": op, "ts_ms": 0, "source": {"lsn": lsn}}
    row = after or before
    return (text({"type": "struct", "fields": [column(key)]}, {key: row[key]}), text(schema, payload), topic, 0, lsn, datetime(2024, 1, 1), 0)


def records(spark, *rows):
    return spark.createDataFrame(rows, RECORD_TYPE).repartition(2)


def test_a_specification_goes_there_and_back():
    for spec in (ORDERS, USERS):
        found, unknown = spec_of(connect_schema(spec), spec.topic)
        assert found.topic == spec.topic and unknown == ()
        assert [(f.name, f.wire, f.scale, f.not_null) for f in found.fields] == [(f.name, f.wire, f.scale, f.not_null) for f in spec.fields]


def test_tables_grow_wider():
    def table(*fields):
        return TableSpec("t", (Field("id", "int"), *fields))

    def wide(one, other):
        field = widened([table(one), table(other)]).field("x")
        return (field.wire, field.precision, field.scale) if field.wire == "decimal" else field.wire

    assert wide(Field("x", "short"), Field("x", "long")) == wide(Field("x", "long"), Field("x", "int")) == "long"
    assert wide(Field("x", "float"), Field("x", "double")) == "double"
    assert wide(Field("x", "decimal", 10, 2), Field("x", "decimal", 8, 5)) == ("decimal", 13, 5)
    assert wide(Field("x", "int"), Field("x", "decimal", 6, 4)) == ("decimal", 14, 4)
    assert wide(Field("x", "int"), Field("x", "double")) == "double"
    assert wide(Field("x", "long"), Field("x", "double")) == wide(Field("x", "date"), Field("x", "int")) == "text"
    both = widened([table(Field("a", "text"), Field("b", "text")), table(Field("b", "text"), Field("c", "text"))])
    assert both.columns == ["id", "b", "c", "a"]
    assert [f.not_null for f in both.fields] == [True, True, False, False]


def test_a_topic_whose_table_changes(spark):
    """A column that grows, one more scale, one that goes, one that comes, and one of an unknown type."""
    first = described(column("id", optional=False), column("n"), amount(2), column("old", "string"))
    second = described(column("id", optional=False), column("n", "int64"), amount(4, 12), column("new", "string"),
                       {"field": "tags", "type": "array", "items": {"type": "string"}, "optional": True},
                       column("at", "int64", "io.debezium.time.Timestamp"))
    bytes_ = {n: base64.b64encode(n.to_bytes(4, "big", signed=True)).decode() for n in (1234, -50000)}
    rows = records(
        spark,
        message(first, {"id": 1, "n": 5, "amount": bytes_[1234], "old": "o"}, 1),
        message(second, {"id": 2, "n": 2**40, "amount": bytes_[-50000], "new": "x", "tags": ["a", "b"], "at": 77}, 2),
        message(second, None, 3, "d", before={"id": 2, "n": None, "amount": None, "new": None, "tags": None, "at": None}),
        message(first, {"id": 9, "n": 1, "amount": None, "old": None}, 4, topic="appdb.public.other"),
        (None, b'{"payload":{"op":"c","ts_ms":0,"source":{"lsn":5},"after":{"id":7,"n":1}}}', TOPIC, 0, 5, datetime(2024, 1, 1), 0),
        (None, None, TOPIC, 0, 6, datetime(2024, 1, 1), 0),
    )
    versions = schema_versions(rows, TOPIC)
    assert [v.first_offset for v in versions] == [1, 2] and versions[1].unknown == ("tags", "at")
    log, table = decode_inferred(rows, TOPIC, extras=("lsn",))
    assert table.columns == ["id", "n", "amount", "new", "old"] and table.key == ("id",)
    got = {r.lsn: r for r in log.collect()}
    assert sorted(got) == [1, 2, 3, 5]
    assert (got[1].pk_id, got[1].n, str(got[1].amount), got[1].old, got[1].new) == (1, 5, "12.3400", "o", None)
    assert (got[2].n, str(got[2].amount), got[2].new) == (2**40, "-5.0000", "x")
    assert json.loads(got[2].rest.toJson()) == {"at": 77, "tags": ["a", "b"]} and got[1].rest is None
    assert got[3].is_deleted and got[3].id == 2 and got[5].n == 1
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "Python" not in plan


def test_schemas_that_are_not_known_stop_the_job(spark):
    first, second = described(column("id")), described(column("id"), column("n"))
    old, new = message(first, {"id": 1}, 1), message(second, {"id": 2, "n": 3}, 2)
    known = schema_versions(records(spark, old), TOPIC)
    with pytest.raises(Exception, match="not known"):
        decode_inferred(records(spark, old, new), TOPIC, known)[0].collect()
    with pytest.raises(ValueError, match="schema part"):
        decode_inferred(records(spark, old), "appdb.public.other")


def test_keys_come_from_the_key_schema(spark):
    schema = described(column("code", "string", optional=False), column("n"))
    key = json.dumps({"type": "struct", "fields": [column("code", "string")]})
    spec, _ = spec_of(json.dumps(schema), TOPIC, key)
    assert spec.key == ("code",)
    row = message(schema, {"code": "x", "n": 1}, 1, key="code")
    log, table = decode_inferred(records(spark, row), TOPIC)
    by_hand = decode(records(spark, row), TableSpec("things", (Field("code", "text"), Field("n", "int")), key=("code",)))
    assert log.drop("rest").collect() == by_hand.collect() and table.key_columns == ["pk_code"]


def test_versions_are_found_without_sorting_the_messages(spark):
    message = F.concat(F.lit('{"schema":{"type":"struct","v":'), F.col("id") % 2, F.lit('},"payload":{}}')).cast("binary")
    records = spark.range(20).select(F.lit("t").alias("topic"), F.lit(None).cast("binary").alias("key"), message.alias("value"), (100 - F.col("id")).alias("offset"))
    found = first_seen(records, "t")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" in plan and "SortAggregate" not in plan
    assert [(r.schema, r.first) for r in found.collect()] == [('{"type":"struct","v":1}', 81), ('{"type":"struct","v":0}', 82)]
