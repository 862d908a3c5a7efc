"""Vector neighbours of large tables: equal vectors as one node, and candidates by signed random
projections.

Equal vectors are one node of the search, however many rows hold them: a node's list of neighbours
serves all its rows, each without itself.  ``exact`` compares all nodes (see ``similarity.nearest``).
``projected`` is approximate: vectors, from which the mean is taken, meet in the buckets of several
tables of random hyperplanes.  A query visits its own bucket of each table and those behind the
hyperplanes that it lies closest to; what it meets is compared exactly.  Buckets that hold very many
vectors are cut into a grid of parts, and queries that meet fewer than k candidates are compared
with all, so that every query has its k neighbours.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from math import log2

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clearset.operators import similarity
from clearset.storage import checked_broadcast, materialize

#: Tables of hyperplanes, vectors that a bucket holds on average, bits that a query flips in each table,
#: and vectors of one part of a bucket.
TABLES, BUCKET_ROWS, PROBES, CELL = 8, 256, 6, 2048

Search = Callable[[DataFrame, DataFrame, int, similarity.Kernel], DataFrame]


def exact(queries: DataFrame, candidates: DataFrame, k: int, kernel: similarity.Kernel) -> DataFrame:
    """(id, nn_id, sim) of the ``k`` best nodes of each node, itself included."""
    return similarity.nearest(queries, candidates, k, kernel, exclude_self=False).select("id", "nn_id", "sim")


def codes(x: np.ndarray, planes: np.ndarray, tables: int, probes: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(table, rows, codes) of vectors: the side of each hyperplane as a bit, and for each of the
    ``probes`` closest ones the code with that bit flipped."""
    bits = planes.shape[1] // tables
    side = (x @ planes).reshape(len(x), tables, bits)
    weights = np.int64(1) << np.arange(bits, dtype=np.int64)
    for t in range(tables):
        own = ((side[:, t] > 0) * weights).sum(1)
        yield t, np.arange(len(x)), own
        for j in np.argsort(np.abs(side[:, t]), axis=1, kind="stable")[:, :probes].T:
            yield t, np.arange(len(x)), own ^ weights[j]


def projected(queries: DataFrame, candidates: DataFrame, k: int, kernel: similarity.Kernel, tables: int = TABLES, bucket_rows: int = BUCKET_ROWS, probes: int = PROBES, seed: int = 42) -> DataFrame:
    """(id, nn_id, sim) like ``exact``, but of the candidates that share a bucket with the query."""
    n = candidates.count()
    bits = max(1, min(40, int(log2(max(2, n / bucket_rows)))))
    center = [r["m"] for r in candidates.select(F.posexplode("vec").alias("i", "x")).groupBy("i").agg(F.avg(F.col("x").cast("double")).alias("m")).orderBy("i").collect()]  # one number a dimension
    middle, planes = np.array(center), np.random.default_rng(seed).normal(size=(len(center), tables * bits))
    id_type, vec_type = (queries.schema[c].dataType.simpleString() for c in ("id", "vec"))

    def coded(d: DataFrame, probes: int) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    for t, rows, code in codes(np.stack(pdf["vec"]).astype(float) - middle, planes, tables, probes):
                        yield pd.DataFrame({"id": pdf["id"].to_numpy()[rows], "vec": pdf["vec"].to_numpy()[rows], "t": t, "code": code})

        return d.select("id", "vec").mapInPandas(run, f"id {id_type}, vec {vec_type}, t int, code long")

    keys = ["t", "code"]

    def hot(side: DataFrame, parts: str) -> DataFrame:
        many = side.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > CELL)
        return many.select(*keys, F.ceil(F.col("n") / CELL).cast("int").alias(parts))

    q, c = coded(queries, min(probes, bits)), coded(candidates, 0)
    grid = checked_broadcast(materialize(hot(q, "q_parts").join(hot(c, "c_parts"), keys, "full"), "hot-buckets"))
    one = lambda parts: F.coalesce(parts, F.lit(1))
    part = lambda parts: F.pmod(F.xxhash64(F.lit("part"), "id"), one(F.col(parts))).cast("int")
    span = lambda parts: F.explode(F.sequence(F.lit(0), one(F.col(parts)) - 1))
    q = q.join(grid, keys, "left").withColumn("qp", part("q_parts")).withColumn("cp", span("c_parts"))
    c = c.join(grid, keys, "left").withColumn("cp", part("c_parts")).withColumn("qp", span("q_parts"))
    cell = [*keys, "qp", "cp"]
    q, c = (d.select(*[F.col(x).alias(x) for x in ("id", "vec", *cell)]) for d in (q, c))
    best = partial(similarity.best_of_blocks, k=k, kernel=kernel, exclude_self=False)
    met = q.groupBy(*cell).cogroup(c.groupBy(*cell)).applyInPandas(lambda a, b: best(a, b), f"id {id_type}, nn_id {id_type}, sim double")
    order = Window.partitionBy("id").orderBy(F.desc("sim"), "nn_id")
    found = met.groupBy("id", "nn_id").agg(F.max("sim").alias("sim")).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    found = materialize(found.select("id", "nn_id", "sim"), "projected-neighbours")
    enough = found.groupBy("id").count().where(F.col("count") >= min(k, n))
    few = materialize(queries.join(enough, "id", "left_anti"), "queries-without-neighbours")
    if few.isEmpty():
        return found
    return found.join(few.select("id"), "id", "left_anti").unionByName(exact(few, candidates, k, kernel))


def nearest(queries: DataFrame, candidates: DataFrame, k: int, kernel: similarity.Kernel, search: Search = exact, id_col: str = "id") -> DataFrame:
    """(id, nn_id, sim, place): the ``k`` best candidates of each query but itself, of (id, vec), found
    among different vectors.  Ids have to be unique."""
    q, c = (d.select(F.col(id_col).alias("id"), F.col("vec").alias("vec")).where("vec IS NOT NULL") for d in (queries, candidates))
    members = c.withColumn("n", F.row_number().over(Window.partitionBy("vec").orderBy("id"))).where(F.col("n") <= k + 1)  # cut before the shuffle
    nodes = materialize(members.groupBy("vec").agg(F.min("id").alias("id"), F.sort_array(F.collect_list("id")).alias("ids")), "vector-nodes")
    of_nodes = nodes.select("id", "vec")
    if queries is candidates:
        asked = both = of_nodes
    else:
        asked = materialize(q.groupBy("vec").agg(F.min("id").alias("id")), "asked-vectors")
        both = asked.select("id", "vec")
    found = search(both, of_nodes, k + 1, kernel)
    rows = found.join(nodes.select(F.col("id").alias("nn_id"), "ids"), "nn_id").select("id", "sim", F.explode("ids").alias("nn_id"))
    order = Window.partitionBy("id").orderBy(F.desc("sim"), "nn_id")  # at most (k + 1) ** 2 rows a node
    rows = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    lists = rows.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "nn_id", "sim"))), lambda x: F.struct(x["nn_id"].alias("nn_id"), x["sim"].alias("sim"))).alias("near"))
    lists = materialize(lists.withColumnRenamed("id", "node"), "node-neighbours")
    own = q.join(asked.withColumnRenamed("id", "node"), "vec").select("id", "node").join(lists, "node")
    near = F.slice(F.filter("near", lambda x: x["nn_id"] != F.col("id")), 1, k)
    return own.select("id", F.posexplode(near).alias("at", "x")).select("id", "x.nn_id", "x.sim", (F.col("at") + 1).alias("place"))
