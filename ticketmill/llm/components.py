"""Connected components by alternating large-star and small-star.

Each step maps every edge to the smallest neighbour that is known, so that components become stars
around their smallest node. A node's smallest neighbour is a grouped minimum joined back to its
edges: minima combine before the shuffle. They are a stored table by then, so that both sides of the
join are plain shuffles and Spark can split a node with many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def _with_smallest(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("_low")).select("u", F.least("u", "_low").alias("m"))
    return edges.join(stored(low, "components-low"), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    known = _with_smallest(down)
    return known.select("v", "m").union(known.select("u", "m")).toDF("u", "v")


def _clean(edges: DataFrame) -> DataFrame:
    return edges.where("u != v").distinct()


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) for every node of an edge (u, v); component is the smallest node that it
    is connected with. Null ends and self-loops are ignored. Each round's edges are written to the
    shared folder; rounds end when a round changes nothing."""
    current = stored(_clean(edges.where("u is not null and v is not null").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))), name)
    mark = _mark(current)
    while True:
        after = stored(_clean(_small_star(_clean(_large_star(current)))), name)
        new = _mark(after)
        if new == mark:
            break
        current, mark = after, new
    stars = after.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())


def _mark(edges: DataFrame) -> tuple:
    """Count and two order-free checksums of the edges."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.bit_xor(h), F.sum(F.shiftright(h, 20))).first())
