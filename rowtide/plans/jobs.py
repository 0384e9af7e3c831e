"""The standing job: change records of some tables into their change logs."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rowtide.sources import read_replay, read_topics
from rowtide.specs import ORDERS, USERS, TableSpec
from rowtide.streaming import await_any, start_changelogs

TABLES = {spec.name: spec for spec in (ORDERS, USERS)}


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--table", action="append", default=[], choices=sorted(TABLES))
    parser.add_argument("--spec", action="append", default=[], help="JSON file of another table")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--servers", help="brokers to read the topics from")
    source.add_argument("--replay", help="folder of records to read instead")
    parser.add_argument("--min-partitions", type=int, help="tasks to read the topics with")
    parser.add_argument("--max-offsets-per-trigger", type=int)
    parser.add_argument("--tables", required=True, help="folder of the change logs")
    parser.add_argument("--checkpoints", required=True, help="folder of the progress")
    parser.add_argument("--by-date", action="store_true", help="one folder per event date")
    parser.add_argument(
        "--rejects", action="store_true", help="keep rejected records beside the log"
    )
    parser.add_argument("--format", default="parquet", help="parquet, or delta with its jar")
    parser.add_argument("--precision", default="second", choices=("second", "micro"))
    parser.add_argument("--on-overflow", default="fail", choices=("fail", "null"))
    parser.add_argument(
        "--extra", action="append", default=[], help="column to keep beside lsn, as position"
    )
    parser.add_argument("--without-lsn", action="store_true", help="keep no log position")
    parser.add_argument("--strict-wrapped", action="store_true")
    when = parser.add_mutually_exclusive_group()
    when.add_argument("--every", help="start a batch this often, as '30 seconds'")
    when.add_argument("--once", action="store_true", help="take all there is and stop")
    args = parser.parse_args(argv)
    if not args.table and not args.spec:
        parser.error("name a --table or a --spec")
    return args


def start(spark: SparkSession, args: argparse.Namespace) -> list[StreamingQuery]:
    """Start one query per table. Rejects, if they are to be kept, come out of the same reading.

    The log position is kept, since states are ordered by it, unless it is declined.
    """
    specs = [TABLES[name] for name in args.table] + [TableSpec.from_file(p) for p in args.spec]

    def records(spec: TableSpec) -> DataFrame:
        if args.replay:
            return read_replay(spark, args.replay, topics=[spec.topic])
        return read_topics(
            spark,
            args.servers,
            [spec.topic],
            min_partitions=args.min_partitions,
            max_offsets_per_trigger=args.max_offsets_per_trigger,
        )

    trigger = None
    if args.once:
        trigger = {"availableNow": True}
    elif args.every:
        trigger = {"processingTime": args.every}
    sink = {"fmt": args.format, "trigger": trigger}
    decoding = {
        "strict_wrapped": args.strict_wrapped,
        "precision": args.precision,
        "on_overflow": args.on_overflow,
        "extras": tuple(dict.fromkeys([*([] if args.without_lsn else ["lsn"]), *args.extra])),
    }
    return start_changelogs(
        records,
        specs,
        args.tables,
        args.checkpoints,
        decode_options=decoding,
        by_date=args.by_date,
        with_rejects=args.rejects,
        **sink,
    )


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName("rowtide").getOrCreate()
    started = start(spark, args)
    if args.once:
        for one in started:
            one.awaitTermination()
    else:
        await_any(spark)
