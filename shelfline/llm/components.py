"""Connected components of an edge table, by alternating star contractions.

Each round links every node to the smallest node it knows: first the larger
neighbours of a node to its smallest neighbour, then the smaller ones. All
steps are joins and grouped minima over the edges; each round is written to
the shared checkpoint folder. It ends when the edges are stars around the
smallest node of each component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour v of u goes to the smallest of u and its neighbours."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("u"), F.least("a", "m").alias("m"))
    return (both.join(least, both["a"] == least["u"]).where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """u and each smaller neighbour go to the smallest neighbour of u."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    linked = down.join(least, down["a"] == least["u"]).where("b != m").select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    return linked.union(least.select("u", "m")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges of one orderable type -> (node, component) for every node
    that is not itself the smallest of its component."""
    now = stored(edges.select("a", "b").where("a != b").distinct(), "cc")
    before = None
    while True:
        state = tuple(now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if state == before or not state[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = state
        now = stored(_small_star(_large_star(now)), "cc")
