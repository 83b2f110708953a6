"""Connected components of an edge table by alternating large and small stars.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Every round is written to
the shared folder, so the plan stays short and a lost executor repeats one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.shared import written


def _centres(pairs: DataFrame) -> DataFrame:
    """(u, m): the smallest of u and its neighbours. Reduced in every task before the shuffle, and
    written: joined back, it is then broadcast if it is small, and a hub's pairs are split if not."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return written(least.select("u", F.least("u", "m").alias("m")), "centres")


def _large_star(edges: DataFrame) -> DataFrame:
    pairs = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    return pairs.join(_centres(pairs), "u").where("v > u").select("v", "m").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges (v, m) with m < v come in; every node and its smaller neighbours go to the least."""
    down = edges.select(F.col("v").alias("u"), F.col("m").alias("v"))
    centres = _centres(down)
    moved = down.join(centres, "u").where("v <> m").select("v", "m")
    return moved.union(centres.select(F.col("u").alias("v"), "m")).distinct()


def _state(edges: DataFrame) -> tuple:
    digest = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return tuple(edges.agg(F.count("*"), digest).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that occurs in `edges(a, b)`; root is the smallest node of its
    component. Self-loops, repeated and reversed edges are allowed, NULLs are not. No edges give an
    empty table."""
    current = written(
        edges.where("a <> b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
        ).distinct(),
        "edges",
    )
    before = None
    while (now := _state(current)) != before:
        if not now[0]:
            break
        before = now
        current = written(
            _small_star(_large_star(current)).select(F.col("v").alias("a"), F.col("m").alias("b")),
            "stars",
        )
    nodes = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.union(nodes.select("root", "root")).distinct()
