"""Connected components of a link table, by alternating stars over joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assaymill.llm.common import stored


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
    larger = both.where("b > a").join(least, "a")
    return larger.select(F.col("m").alias("a"), "b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    least = links.groupBy("b").agg(F.min("a").alias("m"))
    joined = links.join(least, "b")
    return (
        joined.select(F.col("m").alias("a"), F.col("b"))
        .unionByName(joined.where("a > m").select(F.col("m").alias("a"), F.col("a").alias("b")))
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the least node it is connected to, for all nodes of links.

    ``links`` has long ``a`` and ``b``; loops and nulls are left out. Each round is written to
    the shared folder, and the rounds end when nothing changes, after about the logarithm
    of the longest path. A node with very many links is one row per task in the aggregates, which
    are written before the joins, so that adaptive execution can split the node's rows there.
    """
    links = stored(
        links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "links",
    )
    mark = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = None
    while before != (now := mark(links)) and now[0]:
        before = now
        links = stored(_small_star(_large_star(links)), "stars")
    roots = links.select(F.col("a").alias("node")).distinct()
    return links.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
