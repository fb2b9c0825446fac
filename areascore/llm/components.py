"""Connected components of links by alternating large and small stars, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areascore.sources.storage import stage


def _pairs(links: DataFrame) -> DataFrame:
    high, low = F.greatest("a", "b"), F.least("a", "b")
    return links.select(high.alias("a"), low.alias("b")).where("a <> b").distinct()


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked with the node's smallest neighbour."""
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked with the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    joined = links.join(least, "a")
    others = joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return others.unionAll(least.select("a", F.col("m").alias("b")))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Rows (id, component) for every id that occurs in ``links`` (columns a, b); component is the least id.

    Each round is written to the shared folder, so a lost executor costs one round. The number of rounds
    grows with the logarithm of the longest path. Null ids are left out.
    """
    current = stage(_pairs(links.where("a IS NOT NULL AND b IS NOT NULL")), "links")
    before = None
    for _ in range(rounds):
        now = (current.agg(F.count(F.lit(1)), F.sum("b"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))).first()
        if now == before or now[0] == 0:
            break
        before = now
        current = stage(_pairs(_small_star(_pairs(_large_star(current)))), "links")
    else:
        raise RuntimeError("components did not settle")
    least = current.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return least.unionAll(current.select("b", "b")).groupBy("id").agg(F.min("component").alias("component"))
