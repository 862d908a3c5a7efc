"""Connected components of an undirected graph, by alternating large and small stars.

Every round is a pre-aggregated minimum per node and one join, so that a node with very
many neighbours is split by adaptive execution and no neighbour list is ever collected.
Lineage is cut by a table in the shared folder after each round; the one before is deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearset.storage import materialize, release


def _oriented(edges: DataFrame) -> DataFrame:
    """(u, v) with u > v, each once."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def large_star(edges: DataFrame) -> DataFrame:
    """Each node hands its larger neighbours to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _oriented(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def small_star(edges: DataFrame) -> DataFrame:
    """Each node hands itself and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return _oriented(moved.unionByName(least.select("u", F.col("m").alias("v"))))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for each node of ``edges`` (u, v); component: the smallest node.

    Self-loops, repeats and both directions are allowed; nulls take no part.  Raises if the
    rounds do not come to rest within ``max_rounds``.
    """
    now = materialize(_oriented(edges.select("u", "v").dropna()), "components")
    before = _state(now)
    if not before[0]:
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(max_rounds):
        last, now = now, materialize(small_star(large_star(now)), "components")
        release(last)
        after = _state(now)
        if after == before:
            roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
        before = after
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
