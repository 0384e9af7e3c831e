"""The standing job, as it is submitted."""

import json
import os
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from rowtide import ORDERS, USERS
from rowtide.operators import log_of, rejects_of, snapshot_events, to_records
from rowtide.plans import jobs
from rowtide.plans.views import open_lake
from rowtide.sources import read_table, write_replay

ORDER_ROWS = [(i, 1, "Anvil", Decimal("1.25"), datetime(2024, 1, 1)) for i in range(5)]


@pytest.fixture
def topic(spark, tmp_path):
    path = str(tmp_path / "topic")
    orders = spark.createDataFrame(ORDER_ROWS, "id int, user_id int, product_name string, amount decimal(10,2), created_at timestamp_ntz")
    users = spark.createDataFrame([(1, "Ann", "a@x", datetime(2024, 1, 1))], "id int, full_name string, email string, created_at timestamp_ntz")
    for table, spec in ((orders, ORDERS), (users, USERS)):
        records = to_records(snapshot_events(table, spec, F.col("created_at"), F.col("id")), spec)
        write_replay(records, path)
    broken = records.withColumn("value", F.lit("{oops").cast("binary"))
    write_replay(broken, path)
    return path


def run(spark, *argv):
    for one in jobs.start(spark, jobs.arguments(list(argv))):
        one.awaitTermination()


def test_two_tables_and_their_rejects(spark, tmp_path, topic):
    where = ["--tables", str(tmp_path / "lake"), "--checkpoints", str(tmp_path / "progress"),
             "--rejects", "--replay", topic, "--once"]
    run(spark, "--table", "orders", "--table", "users", *where)
    orders = log_of(read_table(spark, str(tmp_path / "lake/orders")), ORDERS)
    assert orders.drop("lsn").schema == ORDERS.log_type()
    assert sorted(r.id for r in orders.collect()) == [0, 1, 2, 3, 4]
    users = read_table(spark, str(tmp_path / "lake/users"))
    assert [r.email for r in log_of(users, USERS).collect()] == ["a@x"]
    rejected = rejects_of(users).collect()
    assert [(r.json, r.reason) for r in rejected] == [("{oops", "malformed")]
    open_lake(spark, str(tmp_path / "lake"), [ORDERS, USERS], prefix="judged_")
    assert spark.sql("SELECT COUNT(*) FROM judged_orders").first()[0] == 5
    assert spark.sql("SELECT reason FROM judged_users_rejects").first()[0] == "malformed"
    run(spark, "--table", "orders", "--table", "users", *where)
    assert read_table(spark, str(tmp_path / "lake/orders")).count() == 5


def test_a_table_by_its_specification(spark, tmp_path, topic):
    conf = ORDERS.to_dict()
    conf["fields"] = [f for f in conf["fields"] if f["name"] in ("id", "amount")]
    path = tmp_path / "spec.json"
    path.write_text(json.dumps(conf))
    run(spark, "--spec", str(path), "--replay", topic, "--once", "--extra", "position", "--tables",
        str(tmp_path / "lake"), "--checkpoints", str(tmp_path / "progress"))
    log = read_table(spark, str(tmp_path / "lake/orders"))
    assert log.columns == ["pk_id", "op", "id", "amount", "event_ts", "is_deleted", "lsn", "position"]
    assert tuple(log.filter("id = 3").first())[-2:] == (3, "3")


def test_lake_of_the_job_answers_sql(spark, tmp_path, topic):
    lake = str(tmp_path / "lake")
    run(spark, "--table", "orders", "--table", "users", "--replay", topic, "--once", "--by-date",
        "--tables", lake, "--checkpoints", str(tmp_path / "progress"))
    assert [f.split("=")[0] for f in os.listdir(f"{lake}/orders") if "=" in f] == ["event_date"]
    open_lake(spark, lake, [ORDERS, USERS], prefix="job_")
    assert spark.sql("SELECT COUNT(*) FROM job_orders").first()[0] == 5
    joined = "SELECT o.*, u.full_name FROM job_orders o JOIN job_users u ON o.user_id = u.id LIMIT 10"
    assert {r.full_name for r in spark.sql(joined).collect()} == {"Ann"}
    assert spark.sql("SELECT op FROM job_users_log").first()[0] == "r"


def test_arguments():
    base = ["--tables", "t", "--checkpoints", "c"]
    with pytest.raises(SystemExit):
        jobs.arguments([*base, "--replay", "r"])
    with pytest.raises(SystemExit):
        jobs.arguments([*base, "--table", "orders"])
    args = jobs.arguments([*base, "--table", "orders", "--servers", "a:1", "--every", "30 seconds"])
    assert (args.every, args.format, args.strict_wrapped) == ("30 seconds", "parquet", False)
