"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.session import materialize


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star step. ``edges`` has u > v. Large: every larger neighbour of u goes to the least of u and its
    neighbours. Small: u and its smaller neighbours go to the least of them."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    joined = both.join(least, "u")
    if large:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))
    return moved.filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b), the component being its least node.

    Each round is written to the shared folder, so lost executors cost one round and the plan stays short. A hub with
    very many edges meets the one-row-per-node side of a join, which adaptive execution splits.
    """
    edges = materialize(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    state = None
    while True:
        edges = materialize(_stars(_stars(edges, True), False), "edges")
        row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if row == state:
            break
        state = row
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
