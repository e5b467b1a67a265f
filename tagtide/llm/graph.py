"""Connected components of a graph given by its edges, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtide.workspace import Scratch, stored


def _print(edges: DataFrame) -> tuple:
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of an edge (u, v); a component is its smallest node.

    Large-star and small-star steps in turn: each moves edges to the smallest neighbour,
    which halves long chains. A hub's edges are reduced map-side to one minimum, and the
    minima are stored, so that the join back to the edges can be split at a hub. Runs jobs
    when called; the result is stored.
    """
    with Scratch(edges.sparkSession, "components") as scratch:
        edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        edges = scratch.stored(edges.where("u > v").distinct(), "edges")
        before = _print(edges)
        while True:
            both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
            least = scratch.stored(least, "least")
            large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            large = scratch.stored(large.distinct(), "large")
            least = scratch.stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
            small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            edges = small.unionAll(least.select("u", F.col("m").alias("v"))).distinct()
            edges = scratch.stored(edges, "edges")
            after = _print(edges)
            if after == before:
                break
            before = after
        roots = edges.select(F.col("v").alias("node")).distinct()
        found = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        return stored(found.unionAll(roots.select("node", F.col("node").alias("component"))), "components")
