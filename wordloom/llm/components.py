"""Connected components of an edge table, by alternating stars.

Each round replaces the edges so that every node points at smaller nodes, until each component
is a star around its smallest node. Rounds grow with the logarithm of the component's size; the
edge table never grows, and nothing of it is collected. The nodes of most edges, the centres of
large components, are few; what is known of them is broadcast, so their edges stay where they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


#: No more than so many nodes are broadcast; nodes with fewer edges than LIGHT never are.
HEAVY_NODES = 50_000
LIGHT = 1000


def _told(edges: DataFrame, least: DataFrame, key: str, n_edges: int) -> DataFrame:
    """``edges`` with ``m`` of the node ``key``, from ``least`` (key, m, n: its number of edges)."""
    # Each edge has two ends, so at most HEAVY_NODES nodes have more edges than this.
    limit = max(LIGHT, 2 * n_edges // HEAVY_NODES)
    if n_edges <= limit:
        return edges.join(least.drop("n"), key)
    heavy = F.broadcast(least.where(F.col("n") > limit).drop("n"))
    at_heavy = edges.join(heavy, key)
    others = edges.join(heavy, key, "left_anti").join(least.where(F.col("n") <= limit).drop("n"), key)
    return at_heavy.unionByName(others)


def _larger(edges: DataFrame, n_edges: int) -> DataFrame:
    """Every node's larger neighbours move to its smallest neighbour (or itself)."""
    ends = edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(edges.select("hi", "lo"))
    least = ends.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select(F.col("u").alias("lo"), F.least("u", "m").alias("m"), "n")
    return _told(edges, least, "lo", n_edges).select("hi", F.col("m").alias("lo"))


def _smaller(edges: DataFrame, n_edges: int) -> DataFrame:
    """Every node and its smaller neighbours move to the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"), F.count("*").alias("n"))
    moved = _told(edges, least, "hi", n_edges).where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.union(least.select("hi", F.col("m").alias("lo"))).distinct()


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for each node of an edge between two different nodes.

    ``edges`` has two columns of one type; the component is its smallest node. Edges with a null end,
    loops and repeats are left out; no edges give an empty table.
    """
    a, b = (F.col(c) for c in edges.columns)
    now = cut(edges.where(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct())
    sign = None
    for _ in range(rounds):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if state == sign or not state[0]:
            break
        sign = state
        moved = _larger(now, state[0])
        # Its joins would be made anew for each use of it.
        moved = cut(moved) if state[0] > LIGHT else moved
        now = cut(_smaller(moved, state[0]))
    else:
        raise RuntimeError("components did not settle")
    leaves = now.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return leaves.union(now.select("lo", "lo").distinct())
