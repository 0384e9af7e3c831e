"""Queries answered from summaries, sets of keys, profiles and common positions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowtide.operators import cuts, profiles, summaries
from rowtide.operators.relations import with_parent
from rowtide.plans import sql
from rowtide.plans import testdata as td
from rowtide.plans.captures import shown_changes, two_versions
from rowtide.plans.registry import ORACLES, query
from rowtide.plans.states import orders_log, users_log
from rowtide.session import scratch


@query(ORACLES["snapshot_diff"])
def snapshot_diff_by_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The changes between two versions of a table, where stored summaries say in which parts to look."""
    folder = scratch(spark, "summaries")
    versions = dict(zip(("old", "new"), two_versions(spark, sf_dir), strict=True))
    for name, version in versions.items():
        summaries.summary(version, td.ORDERS, depth=12).write.parquet(f"{folder}/{name}")
    kept = {f"{name}_summary": spark.read.parquet(f"{folder}/{name}") for name in versions}
    changes = summaries.diff_by_summary(
        *versions.values(), td.ORDERS, F.current_timestamp(), F.lit(1), depth=12, levels=(6,), **kept
    )
    return shown_changes(changes)


def kept_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored set of the keys of all users but a segment's, made of one segment after another."""
    folder, segment = scratch(spark, "bitmaps"), F.col("c_mktsegment")
    table = td.users(spark, sf_dir, segment)
    bitmap = summaries.key_bitmap(table.filter(segment == "BUILDING"), "id")
    for number, name in enumerate(("HOUSEHOLD", "FURNITURE", "AUTOMOBILE")):
        bitmap.write.parquet(f"{folder}/{number}")
        bitmap = summaries.extended_bitmap(spark.read.parquet(f"{folder}/{number}"), table.filter(segment == name), "id")
    bitmap.write.parquet(f"{folder}/all")
    return spark.read.parquet(f"{folder}/all")


@query(ORACLES["fk_violations"])
def orphans_by_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders whose user is not in the stored set of keys."""
    missing = summaries.orphans_by_bitmap(td.orders(spark, sf_dir), kept_users(spark, sf_dir), "user_id")
    return missing.select("id", "user_id")


@query(f"WITH u AS ({sql.USERS}) SELECT id, full_name FROM u WHERE c_mktsegment = 'MACHINERY'")
def absent_ids_by_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users to add to a table of which only the stored set of keys is read."""
    arriving = td.users(spark, sf_dir).select("id", "full_name")
    return summaries.absent_by_bitmap(arriving, kept_users(spark, sf_dir), "id")


def _number(column: str, kind: str) -> str:
    return {"text": f"length({column})", "time": f"epoch_us({column}) / 1e6", "flag": f"CAST({column} AS INT)"}.get(kind, column)


_PROFILED = {
    "pk_id": "", "op": "text", "id": "", "user_id": "", "product_name": "text", "amount": "", "created_at": "time",
    "event_ts": "time", "is_deleted": "flag", "lsn": "",
}
_FIGURES = " UNION ALL ".join(
    f"""SELECT '{c}' AS name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls,
CAST(min({_number(c, k)}) AS DOUBLE) AS low, CAST(max({_number(c, k)}) AS DOUBLE) AS high,
true AS distinct_within, true AS median_within FROM log"""
    for c, k in _PROFILED.items()
)


@query(f"{sql.ORDERS_LOG} {_FIGURES}")
def log_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of all columns of a log, put together from those of its slices by operation, and whether the
    sketches are within their error of exact counts and ranks."""
    log, folder = orders_log(spark, sf_dir), scratch(spark, "profiles")
    log.write.parquet(f"{folder}/log")
    log = spark.read.parquet(f"{folder}/log")
    for op in ("r", "c", "u", "d"):
        profiles.profile(log.filter(F.col("op") == op)).write.parquet(f"{folder}/{op}")
    slices = [spark.read.parquet(f"{folder}/{op}") for op in ("r", "c", "u", "d")]
    found = profiles.figures(profiles.united(*slices), (0.5,))

    middle = {r.name: r.quantiles[0] for r in found.collect()}  # a number a column
    exact = []
    for field in log.schema:
        number, half = profiles.measure(field), F.lit(middle[field.name])
        below, upto = F.count_if(number < half), F.count_if(number <= half)
        part = log.agg(F.countDistinct(field.name).alias("distinct"), below.alias("below"), upto.alias("upto"), F.count(number).alias("known"))
        exact.append(part.select(F.lit(field.name).alias("name"), "*"))
    checked = found.join(reduce(DataFrame.unionByName, exact), "name")
    off = F.abs(F.col("n_distinct") - F.col("distinct"))
    return checked.select(
        "name", "n_rows", "n_nulls", "low", "high",
        (off <= 1 + 0.08 * F.col("distinct")).alias("distinct_within"),
        ((F.col("below") <= 0.53 * F.col("known")) & (F.col("upto") >= 0.47 * F.col("known"))).alias("median_within"),
    )


def shared_positions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Both logs with positions of one source, where a user comes before the orders, and the users' log has
    only come half as far."""
    orders = orders_log(spark, sf_dir).withColumn("lsn", F.lit(1000) + F.col("lsn")).filter("user_id IS NOT NULL")
    orders = orders.withColumn("lsn", F.col("user_id") * 1_000_000_000_000 + F.col("lsn"))
    users = users_log(spark, sf_dir).withColumn("lsn", F.col("pk_id") * 1_000_000_000_000 + F.col("lsn") % 10)
    half = users.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY lsn)")).scalar()
    return {"orders": orders, "users": users.filter(F.col("lsn") <= half)}


_SHARED = f"""
WITH o AS ({sql.ORDERS_LOG} SELECT * REPLACE (user_id * 1000000000000 + 1000 + lsn AS lsn) FROM log WHERE user_id IS NOT NULL),
u AS ({sql.USERS_LOG} SELECT * REPLACE (pk_id * 1000000000000 + lsn % 10 AS lsn) FROM log),
cut AS (SELECT least((SELECT quantile_disc(lsn, 0.5) FROM u), (SELECT max(lsn) FROM o)) AS place),
orders_then AS (SELECT * FROM o WHERE lsn <= (SELECT place FROM cut)
                QUALIFY row_number() OVER (PARTITION BY pk_id ORDER BY lsn DESC) = 1),
users_then AS (SELECT * FROM u WHERE lsn <= (SELECT place FROM cut)
               QUALIFY row_number() OVER (PARTITION BY pk_id ORDER BY lsn DESC) = 1)
"""


@query(
    f"""{_SHARED}
SELECT o.id, o.user_id, o.product_name, o.amount, o.created_at, u.full_name
FROM orders_then o JOIN users_then u ON o.user_id = u.id WHERE NOT o.is_deleted AND NOT u.is_deleted"""
)
def consistent_orders_with_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their users as of the last position that both logs have reached, while one lags."""
    tables = cuts.consistent_states(shared_positions(spark, sf_dir), [td.ORDERS, td.USERS])
    return td.zoneless(with_parent(tables["orders"], tables["users"], "user_id", ["full_name"]))
