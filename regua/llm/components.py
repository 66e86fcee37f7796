"""Connected components of a graph of links, by alternating large and small stars.

Each round points all larger neighbours of a node at its smallest neighbour
(large star), then all smaller ones at the smallest of them (small star). Both
keep components as they are, and the graph ends as one star for each
component. Every round is written to the shared folder; smallest neighbours
are map-side minima, and hub nodes are split by the adaptive skew join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from regua.llm.common import store


def _point(edges: DataFrame, towards: Column) -> DataFrame:
    """Links (node, lowest) after each node's neighbours met its smallest neighbour or itself."""
    low = store(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low")), "low")
    return edges.join(low, "u").select(towards.alias("u"), F.col("low").alias("v"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # What ``u`` sees above itself moves to the smallest that ``u`` sees.
    moved = _point(both.distinct(), F.when(F.col("v") > F.col("u"), F.col("v")))
    return moved.where(F.col("u").isNotNull() & (F.col("u") != F.col("v"))).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # Here every u > v; u itself and its smaller neighbours move to the smallest.
    moved = _point(edges, F.col("v"))
    own = edges.groupBy("u").agg(F.min("v").alias("v"))
    return moved.unionAll(own).where("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple[int, int]:
    total = F.coalesce(F.sum(F.xxhash64("u", "v") % (1 << 40)), F.lit(0))
    return tuple(edges.agg(F.count(F.lit(1)), total).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v: long); root is the smallest node of its component."""
    edges = store(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    before = _mark(edges)
    while before[0]:
        edges = store(_large_star(edges), "large")
        edges = store(_small_star(edges), "small")
        after = _mark(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(roots)
