"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a grouped minimum (pre-aggregated before its shuffle) and an equi-join, and
each round's edges are checkpointed in the shared folder, so neither a large component nor
a hub vertex is gathered anywhere. A round's plans and shuffle files go before the next.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import release


def _large_star(e: DataFrame) -> DataFrame:
    """Link every larger neighbour of u to the smallest of u and its neighbours."""
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
    return (both.filter("v > u").join(least, "u").filter("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(e: DataFrame) -> DataFrame:
    """Link u and its smaller neighbours to the smallest of them (edges have u > v)."""
    least = e.groupBy("u").agg(F.min("v").alias("m"))
    rest = (e.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")))
    return rest.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, root): for every vertex of ``edges`` (u, v long) but the roots themselves, the
    smallest vertex of its component. Self-loops, repeats and nulls in edges are ignored."""
    e = (edges.filter("u is not null and v is not null and u != v")
         .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    e = materialize(e)
    state = None
    while True:
        e = materialize(_small_star(_large_star(e)))
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40))).first()
        if now == state or now[0] == 0:
            return e.select(F.col("u").alias("id"), F.col("v").alias("root"))
        state = now
        release(e.sparkSession)
