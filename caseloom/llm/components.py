"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.operators.joins import join_lookup
from caseloom.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least node of its neighbourhood."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
    return (join_lookup(both, least, "a", "inner").where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("b"), F.col("least").alias("a")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the least of them; b > a holds."""
    least = edges.groupBy("b").agg(F.min("a").alias("least"))
    others = join_lookup(edges, least, "b", "inner").select(F.col("a").alias("b"), F.col("least").alias("a"))
    return others.union(least.select("b", F.col("least").alias("a")))


def _tidy(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("a") < F.col("b")).groupBy("a", "b").agg(F.lit(1).alias("one")).select("a", "b")


def _digest(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum(h.cast("decimal(38,0)"))).first())


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) of every node of the edges (a, b): root is the least node of its component.

    Each round is written to the shared folder, which cuts lineage; nothing but a
    count and a digest reaches the driver.  A hub's neighbours are a many-to-one
    join that adaptive execution splits.  No edges: no rows.
    """
    now = materialize(_tidy(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))), name)
    seen = _digest(now)
    while True:
        now = materialize(_tidy(_small_star(_tidy(_large_star(now)))), name)
        digest = _digest(now)
        if digest == seen:
            break
        seen = digest
    stars = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return stars.union(now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
