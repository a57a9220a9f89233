"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terratally.llm.common import discard, staged


def components(edges: DataFrame) -> DataFrame:
    """``node long, root long``: the smallest node that each node of ``edges (a, b)`` reaches.

    Alternates large and small stars (every node hands its smallest neighbour to its larger, then
    to its smaller ones) until nothing changes; the rounds grow with the logarithm of the longest
    path. Null ends and loops are ignored; no edges give no rows.
    """
    ends = edges.where(F.col("a") != F.col("b"))
    stars = staged(
        ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "stars"
    )
    before = None
    while (now := _state(stars)) != before:
        before = now
        moved = staged(_small(_large(stars)), "stars")
        discard(stars)
        stars = moved
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _state(edges: DataFrame) -> tuple:
    """Tells one set of edges from another."""
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())


def _large(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    larger = both.where(F.col("b") > F.col("a")).join(least, "a")
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    """Edges run from the larger to the smaller end."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    kept = least.select("a", F.col("m").alias("b"))
    return moved.where(F.col("a") != F.col("b")).unionByName(kept).distinct()
