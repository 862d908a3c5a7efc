"""Approximate nearest neighbours by inner product: one robust-pruned directed graph a shard.

Equal vectors are one node; the smallest ids of each are kept beside it.  Nodes are dealt
by hash to shards of bounded size.  A task builds the graph of a shard in batches: greedy
searches from the entry node propose neighbours, relaxed distance pruning keeps diverse
edges, reverse edges are added and pruned alike.  Inner products become distances by one
more coordinate, sqrt(largest norm^2 - norm^2).  The index is a table in the shared
folder; blocks of queries meet every shard there, a beam search answers each, and the
best of all shards are merged by exact score.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take
no part, nor do vectors of another length than most have; ties go to the smaller id; rows
that repeat an id with the same vector are one candidate; a query finds all candidates if
there are no more than k; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clearset.storage import checked_broadcast, materialize

#: Nodes of a shard and queries of a block, on average.  A shard's index is shuffled once for each block, so
#: a block is as large as a task can hold: of the bytes that move, the index is less than half.
SHARD, QUERY_BLOCK = 8192, 16384
#: Out-edges of a node; beam of the searches that build and of those that answer; relaxation.
DEGREE, BUILD_BEAM, BEAM, ALPHA = 32, 64, 112, 1.2
#: Searches that advance together, and nodes each expands in a step.
TOGETHER, WIDE = 256, 4


def beam_search(x: np.ndarray, norms: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, squared distances less the query's norm) of the ``beam`` nearest nodes that each
    search reached, nearest first; -1 pads."""
    b, n = len(queries), len(x)
    ids = np.full((b, beam), -1, np.int32)
    dist = np.full((b, beam), np.inf, np.float32)
    done = np.ones((b, beam), bool)
    ids[:, 0], dist[:, 0], done[:, 0] = entry, norms[entry] - 2 * queries @ x[entry], False
    seen = np.zeros((b, n), bool)
    seen[:, entry] = True
    live = np.arange(b)
    while len(live):
        own_done = done[live]
        pick = np.argsort(own_done, axis=1, kind="stable")[:, :WIDE]  # the nearest that are not expanded
        fresh = ~np.take_along_axis(own_done, pick, axis=1)
        done[live[:, None], pick] = True
        source = np.where(fresh, np.take_along_axis(ids[live], pick, axis=1), -1)
        near = edges[source].reshape(len(live), -1)
        near = np.where(np.repeat(source >= 0, edges.shape[1], axis=1), near, -1)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        row, col = np.nonzero((near >= 0) & ~seen[live[:, None], near])
        node = near[row, col]
        seen[live[row], node] = True
        d = np.full(near.shape, np.inf, np.float32)
        d[row, col] = norms[node] - 2 * np.einsum("ij,ij->i", x[node], queries[live[row]])
        all_d = np.concatenate([dist[live], d], axis=1)
        all_ids = np.concatenate([ids[live], near], axis=1)
        all_done = np.concatenate([done[live], np.isinf(d)], axis=1)
        best = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
        best = np.take_along_axis(best, np.argsort(np.take_along_axis(all_d, best, axis=1), axis=1), axis=1)
        dist[live], ids[live], done[live] = (np.take_along_axis(m, best, axis=1) for m in (all_d, all_ids, all_done))
        live = live[~done[live].all(axis=1)]
    ids[np.isinf(dist)] = -1
    return ids, dist


def robust_prune(x: np.ndarray, norms: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Diverse out-edges of each node: the nearest candidate stays and takes away those that
    are ``alpha`` times nearer to it than to the node."""
    c = np.where(candidates == nodes[:, None], -1, candidates)
    v = x[c]
    to_node = norms[c] + norms[nodes][:, None] - 2 * np.matmul(v, x[nodes][:, :, None])[..., 0]
    alive = c >= 0
    to_node[~alive] = np.inf
    order = np.argsort(to_node, axis=1)
    c, to_node, alive, v = np.take_along_axis(c, order, 1), np.take_along_axis(to_node, order, 1), np.take_along_axis(alive, order, 1), np.take_along_axis(v, order[..., None], 1)
    out = np.full((len(nodes), degree), -1, np.int32)
    rows = np.arange(len(nodes))
    relaxed = alpha * alpha  # distances are squared
    for k in range(degree):
        first = alive.argmax(axis=1)
        has = alive[rows, first]
        if not has.any():
            break
        chosen = c[rows, first]
        out[has, k] = chosen[has]
        between = norms[c] + norms[chosen][:, None] - 2 * np.matmul(v, x[chosen][:, :, None])[..., 0]
        alive &= (relaxed * between > to_node) & (c != chosen[:, None])
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 11) -> tuple[np.ndarray, int]:
    """(out-edges of each node, -1 pads; entry node)."""
    n = len(x)
    rng = np.random.default_rng(seed)
    norms = np.einsum("ij,ij->i", x, x)
    entry = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    edges = rng.integers(0, n, (n, degree), dtype=np.int32)
    edges[:, degree // 2 :] = -1
    order = rng.permutation(n)
    for at in range(0, n, TOGETHER):
        nodes = order[at : at + TOGETHER]
        found, _ = beam_search(x, norms, edges, entry, x[nodes], beam)
        edges[nodes] = robust_prune(x, norms, nodes, unique_rows(np.concatenate([found, edges[nodes]], axis=1)), degree, alpha)
        # reverse edges, grouped by the node they arrive at
        source, target = np.repeat(nodes, degree), edges[nodes].reshape(-1)
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        heads, begin, count = np.unique(target, return_index=True, return_counts=True)
        for group in np.array_split(np.argsort(count, kind="stable"), max(1, len(heads) // TOGETHER)):
            most = int(count[group].max()) if len(group) else 0
            into = np.full((len(group), most), -1, np.int32)
            place = np.arange(most)[None, :]
            ok = place < count[group][:, None]
            into[ok] = source[(begin[group][:, None] + place)[ok]]
            mine = heads[group]
            both = unique_rows(np.concatenate([edges[mine], into], axis=1))
            full = (both >= 0).sum(axis=1) > degree
            packed = -np.sort(-both, axis=1)[:, :degree]
            edges[mine[~full]] = packed[~full] if packed.shape[1] == degree else np.pad(packed[~full], ((0, 0), (0, degree - packed.shape[1])), constant_values=-1)
            if full.any():
                edges[mine[full]] = robust_prune(x, norms, mine[full], both[full], degree, alpha)
    return edges, entry


def unique_rows(ids: np.ndarray) -> np.ndarray:
    """Each row sorted, repeats replaced by -1."""
    ids = np.sort(ids, axis=1)
    ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
    return ids


def augmented(x: np.ndarray) -> np.ndarray:
    """Vectors whose distances to [q, 0] fall as their inner products with q rise."""
    norms = np.einsum("ij,ij->i", x, x)
    return np.concatenate([x, np.sqrt(np.maximum(norms.max(initial=0) - norms, 0))[:, None]], axis=1).astype(np.float32)


def search_shard(raw: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, k: int, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, scores) of the ``k`` best that the beam reached; scores in double precision."""
    x = augmented(raw)
    norms = np.einsum("ij,ij->i", x, x)
    beam = max(beam, k)
    nodes, scores = [], []
    for at in range(0, len(queries), TOGETHER):
        q = queries[at : at + TOGETHER]
        ids, _ = beam_search(x, norms, edges, entry, np.concatenate([q, np.zeros((len(q), 1))], axis=1).astype(np.float32), beam)
        s = np.einsum("ijk,ik->ij", raw[ids].astype(np.float64), q.astype(np.float64))
        s[ids < 0] = -np.inf
        best = np.argsort(-s, axis=1, kind="stable")[:, :k]
        nodes.append(np.take_along_axis(ids, best, 1))
        scores.append(np.take_along_axis(s, best, 1))
    return np.concatenate(nodes), np.concatenate(scores)


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, vec, key) of the vectors that take part, each id and vector once."""
    v = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vec")).where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull())
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    v = v.where(finite & F.exists("vec", lambda x: x != 0))
    size = v.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    v = v.where(F.size("vec") == (size["n"] if size else -1))
    return v.withColumn("key", F.xxhash64("vec")).dropDuplicates(["vec_id", "key"])


def build_index(nodes: DataFrame, shards: int) -> DataFrame:
    """(shard, size, dims, entry, keys, vectors, edges) of the graphs over (key, vec)."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("key")  # rebuilt tasks give the same graph
        raw = np.stack(pdf["vec"].to_numpy()).astype(np.float64)
        edges, entry = build_graph(augmented(raw))
        return pd.DataFrame(
            {"shard": [int(pdf["shard"].iloc[0])], "size": [len(raw)], "dims": [raw.shape[1]], "entry": [entry], "keys": [pdf["key"].to_numpy(np.int64).tobytes()], "vectors": [raw.tobytes()], "edges": [edges.tobytes()]}
        )

    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInPandas(build, "shard int, size int, dims int, entry int, keys binary, vectors binary, edges binary")


def nearest(vectors: DataFrame, is_query, k: int = 20, shard_size: int = SHARD, beam: int = BEAM) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest that were found for each row of
    ``vectors`` (vec_id, embedding) for which the column expression ``is_query`` holds."""
    v = materialize(usable(vectors), "ann-vectors")
    groups = v.groupBy("key").agg(F.min("vec_id").alias("least"), F.count("*").alias("n"), F.first("vec").alias("vec"))
    nodes = materialize(groups, "ann-nodes")
    shards = max(1, -(-nodes.count() // shard_size))
    index = materialize(build_index(nodes.select("key", "vec"), shards), "ann-index")

    queries = v.where(is_query).select("vec_id", "vec")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    # the stated queries meet every shard, in blocks
    queries = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    asked = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    ready = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    # a partition for each shard and block, whatever the session's number
    asked, ready = (d.repartition(shards * blocks, "shard", "block") for d in (asked, ready))

    def answer(q: pd.DataFrame, g: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(g):
            return pd.DataFrame({"query_id": [], "key": [], "score": []})
        g = g.iloc[0]
        raw = np.frombuffer(g["vectors"], np.float64).reshape(g["size"], g["dims"])
        edges = np.frombuffer(g["edges"], np.int32).reshape(g["size"], -1)
        found, scores = search_shard(raw, edges, int(g["entry"]), np.stack(q["vec"].to_numpy()).astype(np.float64), k + 1, beam)
        real = np.isfinite(scores)
        ids = np.repeat(q["vec_id"].to_numpy(np.int64), real.sum(axis=1))
        return pd.DataFrame({"query_id": ids, "key": np.frombuffer(g["keys"], np.int64)[found[real]], "score": scores[real]})

    hits = asked.groupBy("shard", "block").cogroup(ready.groupBy("shard", "block")).applyInPandas(answer, "query_id long, key long, score double")
    named = nodes.select("key", "least", "n")
    hits = hits.join(named, "key")
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "least")
    hits = hits.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= k + 1)
    # of equal vectors only the smallest ids can be among the nearest
    by_id = Window.partitionBy("key").orderBy("vec_id")
    more = v.join(checked_broadcast(materialize(named.where("n > 1").select("key"), "ann-repeats")), "key", "left_semi")
    more = more.select("key", "vec_id").withColumn("i", F.row_number().over(by_id)).where(F.col("i") <= k + 1)
    more = more.groupBy("key").agg(F.collect_list("vec_id").alias("same"))
    hits = hits.join(more, "key", "left").select("query_id", "score", F.explode(F.coalesce("same", F.array("least"))).alias("vec_id"))
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    hits = hits.where("vec_id <> query_id").withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
    return hits.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op3_graph_ann(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, F.col("vec_id") % 20 == 0)
