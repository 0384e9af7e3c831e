"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import stored


def _nearest(edges: DataFrame) -> DataFrame:
    """Every edge with the smallest node among the neighbours of its first node and itself."""
    least = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    return edges.join(least, "a")


def _large_star(edges: DataFrame) -> DataFrame:
    """Links each larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return (
        _nearest(both)
        .filter(F.col("b") > F.col("a"))
        .select(F.col("b").alias("a"), F.col("least").alias("b"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    near = _nearest(edges)
    return (
        near.select(
            F.explode(F.array("a", "b")).alias("a"),
            F.col("least").alias("b"),
        )
        .filter(F.col("a") != F.col("b"))
        .distinct()
    )


def _shape(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count("*"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        ).first()
    )


def components(links: DataFrame) -> DataFrame:
    """Nodes with a link and the smallest node each can reach: ``node, root``.

    ``links`` has two columns of one integer type, in any direction, repeats and links to itself
    allowed; a null end is no link. The steps reduce to the smallest neighbour before they
    shuffle and join it back, so a node with very many links is spread by Spark's skew join. Each
    round is written to the shared folder. The number of rounds grows with the logarithm of the
    longest path.
    """
    one, two = links.columns
    edges = links.select(
        F.greatest(one, two).alias("a"), F.least(one, two).alias("b")
    ).filter(F.col(one).isNotNull() & F.col(two).isNotNull() & (F.col(one) != F.col(two)))
    edges = stored(edges.distinct(), "links")
    before = None
    while (now := _shape(edges)) != before:
        before = now
        if not now[0]:
            break
        edges = stored(_small_star(_large_star(edges)), "stars")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
