"""Mixing sources to target weights, with a limit to how often a source may repeat."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowtide.llm.common import stored
from rowtide.operators.generate import serial_ids

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cycled_weights(sources: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0)) -> DataFrame:
    """``source, weight``: the weights in turn by the sources' code points, null last."""
    flagged = sources.select(F.col("source").isNull().alias("last"), "source")
    numbered = serial_ids(flagged, ["last", "source"], last_id=-1)
    choice = F.array(*(F.lit(float(w)) for w in weights))
    turn = F.pmod("id", F.lit(len(weights))).cast("int")
    return numbered.select("source", F.get(choice, turn).alias("weight"))


def water_fill(sources: DataFrame, budget: float, max_epochs: float) -> DataFrame:
    """``sources`` (with ``weight`` and ``source_size``) with ``target``.

    The budget is shared by weight. Sources whose share passes ``max_epochs`` times their size
    are clamped there and what they leave is shared again, until no share passes its limit. Each
    round is one aggregate over the sources; only its sums come to the driver. A negative or null
    weight is 0. If all sources with a weight are clamped, the rest of the budget stays unused.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    weight = F.greatest(F.coalesce(F.col("weight"), F.lit(0.0)), F.lit(0.0))
    level, clamped = None, -1
    while True:
        over = F.lit(False) if level is None else cap <= weight * level
        row = sources.agg(
            F.count_if(over),
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, weight)), F.lit(0.0)),
        ).first()
        if row[0] == clamped or not row[2]:
            break
        clamped = row[0]
        level = max(float(budget) - row[1], 0.0) / row[2]
    share = F.lit(0.0) if level is None else F.least(cap, weight * F.lit(level))
    if level is not None and not row[2]:
        share = F.when(weight > 0, cap).otherwise(F.lit(0.0))
    return sources.withColumn("target", share)


def mixing_plan(
    docs: DataFrame,
    weights: DataFrame | None = None,
    *,
    ident: str = "doc_id",
    source: str = "source",
    size: Column | None = None,
    budget: float | None = None,
    max_epochs: float = 3.0,
    seed: int = 0,
    buckets: int | None = None,
) -> DataFrame:
    """What each source gives: ``source, source_size, target, whole, cutoff``.

    Every document of a source is taken ``whole`` times, and once more if its ``order_key`` is at
    most ``cutoff``: documents in the seeded order of their ids, as long as the middle of the
    next one lies within what is left of the target. A source so comes within half a document of
    its target. ``size`` is words by default, ``budget`` all sizes, ``weights`` (``source,
    weight``) 1, 2, 3 in turn.

    The order's running sum needs no sort of a whole source: the sums of hash buckets find the one
    that the cutoff lies in, and only its documents are sorted. There are as many buckets as the
    root of the number of documents, so neither a source's buckets nor a bucket's documents grow
    in proportion to it. Null sources are a source of their own, null ids come first in the order, and
    rows that share an id are taken or left together. Null sizes are 0. No documents, no sources.
    """
    sized = docs.select(
        F.col(ident).alias("id"),
        F.col(source).alias("source"),
        (word_count(F.col("text")) if size is None else F.coalesce(size, F.lit(0)).cast("long")).alias("size"),
    )
    narrow = stored(
        sized.groupBy("source", order_key(F.col("id"), seed).alias("key")).agg(F.sum("size").alias("size")),
        "mix-sizes",
    )
    totals = stored(narrow.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    rows, words = narrow.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    given = cycled_weights(totals.select("source")) if weights is None else weights.select("source", "weight")
    known = totals.alias("t").join(
        given.alias("g"), F.col("t.source").eqNullSafe(F.col("g.source")), "left"
    ).select("t.*", "g.weight")
    filled = water_fill(stored(known, "mix-weights"), words if budget is None else budget, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    plan = filled.withColumn("whole", F.floor(epochs).cast("int")).withColumn(
        "quota", F.col("target") - F.col("whole") * F.col("source_size")
    )
    plan = stored(plan, "mix-plan")
    many = buckets or max(1, math.isqrt(rows))
    cutoffs = _cutoffs(narrow, plan.select("source", "quota"), many)
    limited = (
        plan.alias("p")
        .join(cutoffs.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left")
        .select("p.source", "source_size", "target", "whole", F.coalesce("cutoff", F.lit("")).alias("cutoff"))
    )
    # Written, so that documents meet a plain table: Spark sees its size, and can split a large
    # source where it is too large to broadcast.
    return stored(limited, "mix-limits")


def order_key(ident: Column, seed: int) -> Column:
    """The place of an id in the seeded order, as hexadecimal digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), ident.cast("string")).cast("binary"))


def _cutoffs(narrow: DataFrame, quotas: DataFrame, buckets: int) -> DataFrame:
    """The last key of each source whose middle in the running sum is within the quota."""
    prefix = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    keyed = narrow.withColumn("bucket", F.floor(prefix * buckets / F.lit(2**32)).cast("long"))
    before = Window.partitionBy("source").orderBy("bucket")
    sums = (
        keyed.groupBy("source", "bucket")
        .agg(F.sum("size").alias("size"), F.max("key").alias("last"))
        .withColumn("start", F.sum("size").over(before) - F.col("size"))
    )
    placed = (
        sums.alias("s")
        .join(quotas.alias("q"), F.col("s.source").eqNullSafe(F.col("q.source")))
        .select("s.*", "quota")
        .withColumn("inside", F.col("start") + F.col("size") <= F.col("quota"))
    )
    placed = stored(placed, "mix-buckets")
    whole = placed.filter("inside").groupBy("source").agg(F.max("last").alias("cutoff"))
    edge = placed.filter("NOT inside AND start <= quota")
    within = Window.partitionBy("source", "bucket").orderBy("key")
    part = (
        keyed.alias("k")
        .join(
            edge.select("source", "bucket", "start", "quota").alias("e"),
            F.col("k.source").eqNullSafe(F.col("e.source")) & (F.col("k.bucket") == F.col("e.bucket")),
        )
        .select("k.source", "k.bucket", "key", "k.size", "start", "quota")
        .withColumn("middle", F.col("start") + F.sum("size").over(within) - F.col("size") / 2)
        .filter("middle <= quota")
        .groupBy("source")
        .agg(F.max("key").alias("cutoff"))
    )
    return whole.unionByName(part).groupBy("source").agg(F.max("cutoff").alias("cutoff"))


def with_copies(
    docs: DataFrame, plan: DataFrame, *, ident: str = "doc_id", source: str = "source", seed: int = 0
) -> DataFrame:
    """Rows of ``docs`` as a struct ``d``, their source's plan as a struct ``p``, and ``copies``.

    The plan has one row for each source. Documents are not shuffled where Spark finds it small
    enough to broadcast; otherwise its skew join splits a large source.
    """
    again = order_key(F.col(f"d.{ident}"), seed) <= F.col("p.cutoff")
    # Where whole copies are all of the target, texts without words are not taken once more either.
    again = again & ((F.col("p.source_size") == 0) | (F.col("p.target") > F.col("p.whole") * F.col("p.source_size")))
    row, own = F.struct(*(F.col(f"`{c}`") for c in docs.columns)), F.struct(*plan.columns)
    same = F.col(f"d.{source}").eqNullSafe(F.col("p.source"))
    joined = docs.select(row.alias("d")).join(plan.select(own.alias("p")), same)
    return joined.select("d", "p", (F.col("p.whole") + again.cast("int")).alias("copies"))


def mix(docs: DataFrame, weights: DataFrame | None = None, **how) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the plan takes it."""
    plan = mixing_plan(docs, weights, **how)
    names = {k: how[k] for k in ("ident", "source", "seed") if k in how}
    taken = with_copies(docs, plan, **names).filter("copies > 0")
    repeated = F.explode(F.array_repeat("d", F.col("copies")))
    return taken.select(repeated.alias("row")).select("row.*")
