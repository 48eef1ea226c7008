"""Connected components of a graph whose vertices are long integers, in Spark alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, only_row, stored


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(vertex, component): each vertex of an edge with the smallest vertex reachable.

    Alternates two star contractions until no edge changes: every vertex hands its larger neighbours, then its smaller
    ones, to the smallest of its neighbourhood. The number of rounds grows with the logarithm of the longest chain, and
    the edges never grow in number. Each round is a table in the shared folder, which goes when the next is there, so a
    lost executor costs one round at most and the disk holds two; a hub's neighbours are never gathered, only their
    minimum, which is pre-aggregated before the shuffle.
    Empty edges give an empty result; self loops give single vertices.
    """
    current = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = None
    while True:
        # large star: of each vertex, the larger neighbours go to the smallest neighbour
        both = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        loops = current.filter("u = v")
        large = large.union(loops).distinct()
        # small star: a vertex and its smaller neighbours go to the smallest neighbour
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v"))).distinct()
        last, current = current, stored(moved)
        discard(last)
        now = only_row(current.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))))
        if now == before:
            break
        before = now
    found = current.groupBy(F.col("u").alias("vertex")).agg(F.min("v").alias("component"))
    roots = current.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()
    return found.union(roots).groupBy("vertex").agg(F.min("component").alias("component"))
