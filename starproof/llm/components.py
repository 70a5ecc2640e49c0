"""Connected components by alternating large-star and small-star steps (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starproof.llm.scratch import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v) other than a root; root is the component's smallest node.

    Self-loops, repeated and null edges change nothing. Each round is a grouped minimum (combined
    before its shuffle) and an inner join that adaptive execution can split; each is stored, so
    a lost executor costs one round at most. The number of rounds grows with the logarithm of
    the number of nodes.
    """
    now = stored(_oriented(edges), "edges")
    mark = _mark(now)
    while True:
        now = stored(_small_star(_large_star(now)), "edges")
        last, mark = mark, _mark(now)
        if mark == last:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.filter(F.col("u") != F.col("v")).select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    ).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _oriented(both.filter(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _oriented(moved.unionByName(least.select("u", F.col("m").alias("v"))))


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
