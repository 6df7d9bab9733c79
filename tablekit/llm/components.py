"""Connected components of a graph given as edges, by alternating star operations.

Every round joins each vertex's neighbours to the smallest of them (first the
larger neighbours, then the smaller ones); the edges shrink towards stars
around each component's smallest vertex in a logarithmic number of rounds.
Minima are pre-aggregated, and the edge side of each join is a plain shuffle
join that adaptive execution may split, so one vertex may hold any share of
the edges.  A round's shuffles and edges go when the next one has been written,
so disk doesn't grow with the number of rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import checkpointed, release


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .filter("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point down (a > b)."""
    low = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b")
    return moved.union(low.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every vertex of ``edges(a long, b long)``; the smallest vertex names it."""
    now = checkpointed(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                       .distinct())
    before = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.col("b").cast("decimal(38,0)")).alias("s"),
                        F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if state == before:
            break
        before = state
        now = checkpointed(_small_star(_large_star(now)))
        release(edges.sparkSession)
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        now.select(F.col("b"), F.col("b")).distinct())
