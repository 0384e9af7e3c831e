"""Rows for load and for tests: users, their orders, and serial ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rowtide.functions import capitalise, money, uniform, uniform_int
from rowtide.session import shared_folder

# Words for product names.
WORDS = ("anvil", "basket", "candle", "drum", "easel", "funnel", "goblet")

# Orders per user, and the range of their amounts.
ORDERS_PER_USER = (1, 3)
AMOUNTS = (10, 500)


def new_users(
    spark: SparkSession, n: int, first_id: int = 1, now: Column | None = None
) -> DataFrame:
    """``n`` users with ids from ``first_id``, made in parallel from a range."""
    tag = F.lpad(F.col("id").cast("string"), 12, "0")
    return spark.range(first_id, first_id + n).select(
        "id",
        F.concat(F.lit("User "), tag).alias("full_name"),
        F.concat(F.lit("user"), tag, F.lit("@example.com")).alias("email"),
        (F.current_timestamp() if now is None else now).alias("created_at"),
    )


def new_orders(
    users: DataFrame,
    *,
    count: Column | None = None,
    share: Column | None = None,
    word: Column | None = None,
    now: Column | None = None,
) -> DataFrame:
    """One to three orders for every user, without ids (``serial_ids`` gives them).

    ``count``, ``share`` (in [0, 1), for the amount) and ``word`` default to random values; the
    last two may use ``id`` and ``n``, the number of the order within its user.
    """
    drawn = uniform_int(*ORDERS_PER_USER, F.rand()) if count is None else count
    each = users.select("id", drawn.alias("_count")).select(
        "id", F.explode(F.sequence(F.lit(1), F.col("_count"))).alias("n")
    )
    if word is None:
        words = F.array(*(F.lit(w) for w in WORDS))
        word = F.element_at(words, uniform_int(1, len(WORDS), F.rand()))
    return each.select(
        F.col("id").alias("user_id"),
        "n",
        capitalise(word).alias("product_name"),
        money(uniform(*AMOUNTS, F.rand() if share is None else share)).alias("amount"),
        (F.current_timestamp() if now is None else now).alias("created_at"),
    )


def serial_ids(
    rows: DataFrame, order_by: list[str], last_id: int = 0, partitions: int | None = None
) -> DataFrame:
    """Add ``id``: ``last_id + 1`` and on without gaps, in the order of ``order_by``.

    Rows are range-partitioned and sorted, and counted per partition; a partition's ids start
    after the rows of those before it. Only those counts, one per partition, meet in one task.
    Their starts are broadcast, a row per partition. The sorted rows are checkpointed in the
    shared folder between the two steps, so a lost executor cannot renumber some of them. Rows
    of equal order go by their content, and by input position where that is equal too, which
    lets any number of them spread over partitions.
    """
    spark = rows.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    ties = {"_content": F.xxhash64(*rows.columns), "_place": F.monotonically_increasing_id()}
    order = [*order_by, *ties]
    count = () if partitions is None else (partitions,)
    position = F.monotonically_increasing_id()
    kept = (
        rows.withColumns(ties)
        .repartitionByRange(*count, *order)
        .sortWithinPartitions(*order)
        .drop(*ties)
        .withColumn("_part", F.shiftright(position, 33).cast("int"))
        .withColumn("_pos", position.bitwiseAND(F.lit((1 << 33) - 1)))
        .checkpoint()
    )
    sizes = kept.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    return kept.join(F.broadcast(starts), "_part").select(
        (F.lit(last_id + 1) + F.col("_start") + F.col("_pos")).alias("id"), *rows.columns
    )


def ingest_summary(users: DataFrame, added_orders: DataFrame) -> DataFrame:
    """Number of all users and of the orders a cycle added, in one row."""
    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    marks = users.select(one.alias("u"), zero.alias("o")).unionAll(
        added_orders.select(zero.alias("u"), one.alias("o"))
    )
    return marks.agg(
        F.coalesce(F.sum("u"), zero).alias("users_total"),
        F.coalesce(F.sum("o"), zero).alias("orders_added"),
    )
