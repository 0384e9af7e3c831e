"""Logs decoded by what the messages say of themselves."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.operators.capture import connect_schema, to_records
from rowtide.plans import sql
from rowtide.plans import testdata as td
from rowtide.plans.registry import query
from rowtide.plans.streams import first_and_later
from rowtide.sources import decode_inferred


@query(f"{sql.EVENTS_LOG} SELECT {sql.EVENTS_COLUMNS} FROM log")
def events_changelog_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events log without a specification: the messages' schema part gives it."""
    records = td.event_records(spark, sf_dir, schema=connect_schema(td.EVENTS))
    log, table = decode_inferred(records, td.EVENTS.topic)
    return td.zoneless(log.select(*table.log_type().fieldNames()))


def evolved_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of events whose first changes had 32-bit users and no properties."""
    fields = [replace(f, wire="int") if f.name == "user_id" else f for f in td.EVENTS.fields if f.name != "props"]
    early = replace(td.EVENTS, fields=tuple(fields))
    first, later = first_and_later(td.events_history(spark, sf_dir))
    narrow = {s: F.col(s).dropFields("props").withField("user_id", F.col(f"{s}.user_id").cast("int")) for s in ("before", "after")}
    old = to_records(first.withColumns(narrow), early, schema=connect_schema(early))
    return old.unionByName(to_records(later, td.EVENTS, schema=connect_schema(td.EVENTS)))


@query(
    f"""{sql.EVENTS_LOG} SELECT * REPLACE (CASE WHEN op NOT IN ('r', 'c') THEN props END AS props)
FROM (SELECT {sql.EVENTS_COLUMNS} FROM log)"""
)
def events_changelog_evolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of a topic whose table changed half-way: a column became wider, and one was added."""
    log, table = decode_inferred(evolved_events(spark, sf_dir), td.EVENTS.topic)
    return td.zoneless(log.select(*table.log_type().fieldNames()))
