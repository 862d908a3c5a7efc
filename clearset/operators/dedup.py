"""Removal of near duplicates by perceptual hash: greedy leaders, and clusters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearset.operators.components import connected_components
from clearset.operators.similarity import near_hashes
from clearset.storage import materialize, release


def _classes(df: DataFrame, id_col: str, hash_col: str) -> DataFrame:
    """(h, first) of each different hash: its smallest id stands for all of them."""
    known = df.where(F.col(hash_col).isNotNull())
    return known.groupBy(F.col(hash_col).alias("h")).agg(F.min(id_col).alias("first"))


def greedy_dedup(df: DataFrame, max_distance: int, id_col: str = "id", hash_col: str = "hash", max_rounds: int = 200, bits: int = 64) -> DataFrame:
    """(id, leader, dist, suspicion_score) of the removed rows.

    As if in id order each row that is still there removed all later rows within the
    distance.  By rounds: a row whose smaller neighbours are all removed leads, and removes
    its larger ones; rows with equal hashes share their first row's fate.  A hash is a long
    or an array of longs; ``bits``: of all its words, so that no band is constant.  Raises if ``max_rounds`` do not settle every row.
    """
    classes = materialize(_classes(df, id_col, hash_col), "hash-classes")
    pairs = near_hashes(df, max_distance, hash_col, bits)
    ends = pairs.join(classes.select(F.col("h").alias("ha"), F.col("first").alias("a")), "ha").join(classes.select(F.col("h").alias("hb"), F.col("first").alias("b")), "hb")
    edges = materialize(ends.select(F.least("a", "b").alias("small"), F.greatest("a", "b").alias("large"), "dist"), "hash-edges")
    # nodes without any edge lead from the start and remove only their equals
    state = materialize(edges.select(F.col("small").alias("node")).union(edges.select("large")).distinct().withColumn("leads", F.lit(None).cast("boolean")), "greedy")
    for _ in range(max_rounds):
        if not state.where("leads IS NULL").take(1):
            break
        smaller = edges.join(state.select(F.col("node").alias("small"), F.col("leads").alias("by")), "small")
        seen = smaller.groupBy(F.col("large").alias("node")).agg(F.max(F.coalesce("by", F.lit(False))).alias("hit"), F.max(F.col("by").isNull()).alias("open"))
        new = state.join(seen, "node", "left").select(
            "node", F.coalesce("leads", F.when(F.coalesce("hit", F.lit(False)), F.lit(False)).when(~F.coalesce("open", F.lit(False)), F.lit(True))).alias("leads")
        )
        last, state = state, materialize(new, "greedy")
        release(last)
    else:
        raise RuntimeError(f"not settled after {max_rounds} rounds")
    leaders = state.where("leads").select(F.col("node").alias("small"))
    lead = edges.join(leaders, "small").groupBy(F.col("large").alias("first")).agg(F.min(F.struct("small", "dist")).alias("l"))
    lost = state.where("NOT leads").select(F.col("node").alias("first")).join(lead, "first")
    fate = classes.join(lost, "first", "left").select("h", "first", F.coalesce("l.small", "first").alias("leader"), F.coalesce("l.dist", F.lit(0)).alias("dist"))
    rows = df.select(F.col(id_col).alias("id"), F.col(hash_col).alias("h")).join(fate, "h").where("id <> leader")
    return rows.select("id", "leader", "dist", (1 - F.col("dist") / (max_distance + 1)).alias("suspicion_score"))


def duplicate_clusters(df: DataFrame, max_distance: int, id_col: str = "id", hash_col: str = "hash", bits: int = 64) -> DataFrame:
    """(id, cluster): the smallest id that a chain of near hashes reaches; rows without a hash
    are clusters of their own.  ``bits``: of a hash, so that no band of it is constant."""
    classes = materialize(_classes(df, id_col, hash_col), "hash-classes")
    pairs = near_hashes(df, max_distance, hash_col, bits)
    ends = pairs.join(classes.select(F.col("h").alias("ha"), F.col("first").alias("u")), "ha").join(classes.select(F.col("h").alias("hb"), F.col("first").alias("v")), "hb")
    parts = connected_components(ends.select("u", "v"))
    named = classes.join(parts, F.col("first") == F.col("node"), "left").select("h", F.coalesce("component", "first").alias("cluster"))
    rows = df.select(F.col(id_col).alias("id"), F.col(hash_col).alias("h")).join(named, "h", "left")
    return rows.select("id", F.coalesce("cluster", "id").alias("cluster"))


def representatives(clusters: DataFrame) -> DataFrame:
    """The rows that stay: one of each cluster."""
    return clusters.where("id = cluster").select("id")
