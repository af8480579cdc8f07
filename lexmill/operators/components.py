"""Connected components of a graph of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.operators.keyed import lookup
from lexmill.storage import stored


def star(edges: DataFrame, count: int, large: bool) -> DataFrame:
    """Large star: each node's larger neighbours join its smallest one. Small star: its smaller
    neighbours and itself do. Minima are pre-aggregated, and the edges of a hub, which learn its
    minimum, stay where they are."""
    both = edges.union(edges.select("v", "u")) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n")).select("u", F.least("u", "m").alias("m"), "n")
    near = lookup(both, least, "u", "n", (1 + large) * count)
    if large:
        near = near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        near = near.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return near.where("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for edges ``u, v``: the smallest node that each node reaches.

    Large and small stars alternate until the edges no longer change: then each edge joins a node
    to its component's smallest. Nodes that are a component's smallest aren't listed.
    """
    edges, before = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges"), None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now
        wide = stored(star(edges, now[0], True), "large-star")
        edges = stored(star(wide, now[0], False), "small-star")
