"""Hash and vector similarity: threshold joins by banding, exact neighbours by blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil, sqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from clearset.operators.bands import hamming, is_wide, meet, pairs_within, words_of
from clearset.storage import materialize, release, small_arrow

#: Rows of one block of the neighbour search: two blocks and their distances fit a task.
BLOCK_ROWS = 2048
#: Rows of a block that a kernel computes at once, so that what it computes with stays in the cache.
STRIP = 128
#: Blocks of one file: a task of the neighbour search reads some files of either side.
SPAN = 16
#: Bytes of blocks that go to a Python worker at once, and blocks that it keeps unpacked.
ARROW_BYTES, UNPACKED = 8 << 20, 16


def sign_hash(vector: str, n: int = 64, above: float = 0.0) -> Column:
    """Hash of the first ``n`` components of a vector: one bit each, 1 where greater than
    ``above``, the first component highest."""
    bits = F.transform(F.slice(vector, 1, n), lambda x: F.when(x > above, F.lit(1)).otherwise(F.lit(0)).cast("long"))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: F.shiftleft(a, 1).bitwiseOR(b))


def _band(word: Callable[[int], Column], start: int, end: int) -> Column:
    """The bits ``start`` to ``end`` (exclusive) of a hash as an array, an entry for each word
    that they touch; bit 0 is the lowest of the first word."""
    pieces = []
    for w in range(start // 64, -(-end // 64)):
        low, high = max(start - 64 * w, 0), min(end - 64 * w, 64)
        piece = F.shiftrightunsigned(word(w), low)
        pieces.append(piece.bitwiseAND(F.lit((1 << (high - low)) - 1)) if high - low < 64 else piece)
    return F.array(*pieces)


def near_hashes(df: DataFrame, max_distance: int, hash_col: str = "hash", bits: int = 64) -> DataFrame:
    """(ha, hb, dist) of all pairs of different hashes within ``max_distance``, ha < hb.

    A hash is a long, or an array of longs (``bits`` counts those of all words, arrays have one
    length).  Hashes that differ in so few bits agree on one of max_distance + 1 bands, so an
    equi-join on (band, bits of the band) finds every pair.  Each hash is one row of it,
    however many ids share it; bands that very many hashes share are compared part by part.
    """
    wide = is_wide(df, hash_col)
    kind = df.schema[hash_col].dataType.simpleString()
    distinct = materialize(df.where(F.col(hash_col).isNotNull()).select(F.col(hash_col).alias("h")).distinct(), "distinct-hashes")
    bands = max_distance + 1
    edges = [bits * i // bands for i in range(bands + 1)]
    word = (lambda w: F.element_at("h", w + 1)) if wide else (lambda w: F.col("h"))
    keys = [F.struct(F.lit(i).alias("band"), _band(word, edges[i], edges[i + 1]).alias("key")) for i in range(bands) if edges[i] < edges[i + 1]]
    if len(keys) < bands:
        raise ValueError(f"max_distance {max_distance} leaves no bit for each band of {bits} bits")
    banded = distinct.select("h", F.explode(F.array(*keys)).alias("k")).select("h", "k.band", "k.key")

    def light(a: DataFrame, b: DataFrame) -> DataFrame:
        a, b = a.withColumnRenamed("h", "ha"), b.withColumnRenamed("h", "hb")
        near = a.join(b, ["band", "key"]).where(F.col("ha") < F.col("hb")).withColumn("dist", hamming(F.col("ha"), F.col("hb"), wide).cast("int"))
        return near.where(F.col("dist") <= max_distance).select("ha", "hb", "dist")

    met = meet(banded, banded.select("h", "band", "key"), light, pairs_within(max_distance), f"ha {kind}, hb {kind}, dist int", triangle=True)
    return met.select(F.least("ha", "hb").alias("ha"), F.greatest("ha", "hb").alias("hb"), "dist").distinct()


def hamming_pairs(df: DataFrame, max_distance: int, id_col: str = "id", hash_col: str = "hash", bits: int = 64) -> DataFrame:
    """(id_a, id_b, dist) of all pairs of ids within ``max_distance``.  Rows with one hash make
    pairs by the square of their number: to remove duplicates use ``dedup``, which works on
    hashes and never opens them."""
    known = df.where(F.col(hash_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(hash_col).alias("h"))
    same = known.select(F.col("h").alias("ha"), F.col("h").alias("hb"), F.lit(0).alias("dist")).distinct()
    near = near_hashes(df, max_distance, hash_col, bits).unionByName(same)
    left, right = known.select(F.col("id").alias("ia"), F.col("h").alias("ha")), known.select(F.col("id").alias("ib"), F.col("h").alias("hb"))
    pairs = near.join(left, "ha").join(right, "hb").where((F.col("ha") != F.col("hb")) | (F.col("ia") < F.col("ib")))
    return pairs.select(F.least("ia", "ib").alias("id_a"), F.greatest("ia", "ib").alias("id_b"), "dist")


Kernel = Callable[[pd.DataFrame, pd.DataFrame], np.ndarray]


def _matrix(pdf: pd.DataFrame, col: str) -> np.ndarray:
    return np.stack(pdf[col].to_numpy()).astype(np.float64)


def _strips(n: int, m: int, part: Callable[[int, int], np.ndarray]) -> np.ndarray:
    """The ``n`` x ``m`` matrix of ``part`` (first row, last row), computed strip by strip."""
    out = np.empty((n, m))
    for at in range(0, n, STRIP):
        out[at : at + STRIP] = part(at, min(n, at + STRIP))
    return out


def euclidean(q: pd.DataFrame, c: pd.DataFrame) -> np.ndarray:
    """Negative distances: larger is nearer for every kernel.  Distances that the product leaves to
    rounding are taken from the differences, so that equal vectors are at 0."""
    x, y = _matrix(q, "vec"), _matrix(c, "vec")
    nx, ny, yt = (x * x).sum(1)[:, None], (y * y).sum(1)[None, :], -2 * y.T

    def part(lo: int, hi: int) -> np.ndarray:
        both = nx[lo:hi] + ny
        sq = x[lo:hi] @ yt
        sq += both
        both *= 1e-9
        i, j = np.nonzero(sq <= both)
        for at in range(0, len(i), 1 << 16):
            a, b = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
            sq[a, b] = ((x[lo + a] - y[b]) ** 2).sum(1)
        np.maximum(sq, 0, out=sq)
        np.sqrt(sq, out=sq)
        return np.negative(sq, out=sq)

    return _strips(len(x), len(y), part)


def cosine(q: pd.DataFrame, c: pd.DataFrame) -> np.ndarray:
    x, y = _matrix(q, "vec"), _matrix(c, "vec")
    x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-8
    y /= np.linalg.norm(y, axis=1, keepdims=True) + 1e-8
    return x @ y.T


def _hamming_matrix(q: pd.DataFrame, c: pd.DataFrame) -> np.ndarray:
    (known_a, a), (known_b, b) = words_of(q["hash"]), words_of(c["hash"])

    def part(lo: int, hi: int) -> np.ndarray:
        d = np.zeros((hi - lo, len(b)), np.uint16)
        for w in range(min(a.shape[1], b.shape[1])):
            d += np.bitwise_count(a[lo:hi, w][:, None] ^ b[:, w][None, :])
        return d

    d = _strips(len(a), len(b), part)
    d[~known_a] = np.inf
    d[:, ~known_b] = np.inf
    return d


def hamming_kernel(q: pd.DataFrame, c: pd.DataFrame) -> np.ndarray:
    return -_hamming_matrix(q, c)


def fused(bits: int = 64, hash_weight: float = 0.6) -> Kernel:
    """hash_weight * (1 - distance / bits) + (1 - hash_weight) * cosine; a missing hash is
    infinitely far."""

    def kernel(q: pd.DataFrame, c: pd.DataFrame) -> np.ndarray:
        return hash_weight * (1 - _hamming_matrix(q, c) / bits) + (1 - hash_weight) * cosine(q, c)

    return kernel


def _top(a: pd.DataFrame, b: pd.DataFrame, s: np.ndarray, k: int) -> pd.DataFrame:
    """(id, nn_id, sim): the ``k`` best columns of each row; ``b`` is in the order of its ids."""
    top = np.argsort(-s, axis=1, kind="stable")[:, :k]
    s = np.take_along_axis(s, top, 1)
    ok = s > -np.inf
    return pd.DataFrame({"id": np.repeat(a["id"].to_numpy(), ok.sum(1)), "nn_id": b["id"].to_numpy()[top[ok]], "sim": s[ok]})


def best_of_blocks(a: pd.DataFrame, b: pd.DataFrame, k: int, kernel: Kernel, exclude_self: bool = True, both: bool = False) -> pd.DataFrame:
    """(id, nn_id, sim) of the ``k`` best rows of ``b`` for each row of ``a``, ties by the smaller id;
    ``both``: also of the best rows of ``a`` for each row of ``b``, from the same comparison."""
    if not len(a) or not len(b):
        return pd.DataFrame({"id": [], "nn_id": [], "sim": []}, dtype=object)  # ids may be text
    a, b = a.sort_values("id", ignore_index=True), b.sort_values("id", ignore_index=True)
    s = kernel(a, b)
    if exclude_self:
        s[a["id"].to_numpy()[:, None] == b["id"].to_numpy()[None, :]] = -np.inf
    found = _top(a, b, s, k)
    return pd.concat([found, _top(b, a, s.T, k)]) if both else found


class Best:
    """The ``k`` best neighbours found so far of each row of a block, ties by the smaller id."""

    def __init__(self, ids: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.sim = np.full((len(ids), k), -np.inf)
        self.nn = np.empty((len(ids), k), ids.dtype)

    def offer(self, s: np.ndarray, ids: np.ndarray, axis: int = 0) -> None:
        """``s``: the similarities of the block's rows, which lie along ``axis``, to the rows ``ids``, which
        are in their order."""
        least = self.sim.min(1)
        new = np.flatnonzero(least == -np.inf)
        if s.shape[1 - axis] > self.k:  # rows without k neighbours yet: no worse than their k best here
            for at in range(0, len(new), STRIP):
                own = new[at : at + STRIP]
                cut = -np.partition(-(s[own] if axis == 0 else s[:, own].T), self.k - 1, axis=1)[:, self.k - 1]
                least[own] = np.where(np.isnan(cut), -np.inf, cut)
        least = np.maximum(least, np.finfo(float).min)
        at = np.nonzero(s >= (least[:, None] if axis == 0 else least[None, :]))
        sim, rows, cols = s[at], at[axis], at[1 - axis]
        if len(rows) > 2 * self.k * len(self.ids):  # of those that equal the least of a row the first k are enough
            order = np.lexsort((cols, rows))
            equal = order[sim[order] == least[rows[order]]]
            first = np.arange(len(equal)) - np.searchsorted(rows[equal], rows[equal]) < self.k
            few = np.r_[np.flatnonzero(sim > least[rows]), equal[first]]
            sim, rows, cols = sim[few], rows[few], cols[few]
        touched = np.unique(rows)
        old = self.sim[touched] > -np.inf
        rows, sim, nn = np.r_[np.repeat(touched, old.sum(1)), rows], np.r_[self.sim[touched][old], sim], np.concatenate([self.nn[touched][old], ids[cols]])
        order = np.lexsort((np.unique(nn, return_inverse=True)[1], -sim, rows))
        rows, sim, nn = rows[order], sim[order], nn[order]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        stay = place < self.k
        self.sim[touched] = -np.inf
        self.sim[rows[stay], place[stay]], self.nn[rows[stay], place[stay]] = sim[stay], nn[stay]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(id, nn_id, sim)."""
        some = self.sim > -np.inf
        return np.repeat(self.ids, some.sum(1)), self.nn[some], self.sim[some]


def packed(d: DataFrame, blocks: int, name: str) -> DataFrame:
    """(block, rows): ``d`` (id and more) dealt into ``blocks`` by a hash of the id, and written with each
    block as one value.  Vectors go as single floats where these hold them exactly."""

    def pack(table: pa.Table) -> pa.Table:
        block, table = table.column("block")[0].as_py(), table.drop_columns(["block"]).sort_by("id").combine_chunks()
        if "vec" in table.column_names:
            vec = table.column("vec").combine_chunks()
            vec = vec.chunk(0) if isinstance(vec, pa.ChunkedArray) else vec
            x = vec.flatten()
            single = x.cast(pa.float32(), safe=False)
            if vec.null_count == 0 and single.cast(x.type).equals(x):
                ends = np.cumsum([0, *vec.value_lengths().to_numpy(zero_copy_only=False)])
                table = table.set_column(table.column_names.index("vec"), "vec", pa.ListArray.from_arrays(pa.array(ends, pa.int32()), single))
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        return pa.table({"block": pa.array([block], pa.int32()), "rows": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    # files enough for several tasks a core, since each file of one side meets each of the other
    cores = d.sparkSession.sparkContext.defaultParallelism
    files = min(blocks, max(-(-blocks // SPAN), ceil(sqrt(4 * cores))))
    d = d.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).repartition(files, "block")
    return materialize(d.groupBy("block").applyInArrow(pack, "block int, rows binary"), name)


def nearest(queries: DataFrame, candidates: DataFrame, k: int, kernel: Kernel, id_col: str = "id", block_rows: int = BLOCK_ROWS, exclude_self: bool = True) -> DataFrame:
    """(id, nn_id, sim, place): the exact ``k`` best candidates of each query but itself.

    Both sides are written as blocks of bounded size.  Every block of queries meets every block of
    candidates in the product of the two tables, whose tasks read their parts of both from storage, so
    that nothing is shuffled that repeats a row.  A task keeps the ``k`` best of each row over all blocks
    that it compares; the tasks' winners are merged by query.  A table that is searched in itself meets
    each unordered pair of blocks once, which serves the rows of both.  Ties go to the smaller id.  This
    compares all queries with all candidates, which is what the exact answer asks for.
    """
    payload = [c for c in ("vec", "hash") if c in queries.columns]
    triangle = queries is candidates
    id_type, kind = queries.schema[id_col].dataType.simpleString(), to_arrow_type(queries.schema[id_col].dataType)
    sides = []
    for d, name in ((queries, "query-blocks"), (candidates, "candidate-blocks"))[: 1 if triangle else 2]:
        d = d.select(F.col(id_col).alias("id"), *payload)
        sides.append(packed(d, max(1, -(-d.count() // block_rows)), name))
    q = sides[0].select(F.col("block").alias("qb"), F.col("rows").alias("q"))
    c = sides[-1].select(F.col("block").alias("cb"), F.col("rows").alias("c")).hint("shuffle_replicate_nl")
    if triangle:
        # one of both orders of each pair, so that tasks on either side of the diagonal have half of theirs
        odd = (F.col("qb") + F.col("cb")) % 2 == 1
        met = q.join(c, (F.col("qb") == F.col("cb")) | ((F.col("qb") < F.col("cb")) & ~odd) | ((F.col("qb") > F.col("cb")) & odd))
    else:
        met = q.crossJoin(c)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[tuple[bool, int], Best] = {}
        tables: dict[tuple[bool, int], pd.DataFrame] = {}

        def unpacked(key: tuple[bool, int], value: pa.Scalar) -> pd.DataFrame:
            if key not in tables:
                if len(tables) >= UNPACKED:
                    del tables[next(iter(tables))]
                tables[key] = pa.ipc.open_stream(value.as_buffer()).read_pandas()
            return tables[key]

        for batch in batches:
            for i in range(batch.num_rows):
                qb, cb = (True, batch.column(0)[i].as_py()), (triangle, batch.column(2)[i].as_py())
                a, b = unpacked(qb, batch.column(1)[i]), unpacked(cb, batch.column(3)[i])
                x, y = a["id"].to_numpy(), b["id"].to_numpy()
                s = kernel(a, b)
                if exclude_self:
                    own = np.flatnonzero(np.isin(x, y))
                    for at in range(0, len(own), STRIP):
                        r, j = np.nonzero(x[own[at : at + STRIP]][:, None] == y[None, :])
                        s[own[at + r], j] = -np.inf
                kept.setdefault(qb, Best(x, k)).offer(s, y)
                if triangle and qb != cb:
                    kept.setdefault(cb, Best(y, k)).offer(s, x, axis=1)
        for own in kept.values():
            ids, nn, sim = own.found()
            yield pa.RecordBatch.from_arrays([pa.array(ids, kind), pa.array(nn, kind), pa.array(sim)], ["id", "nn_id", "sim"])

    with small_arrow(queries.sparkSession, ARROW_BYTES):
        found = met.select("qb", "q", "cb", "c").mapInArrow(best, f"id {id_type}, nn_id {id_type}, sim double")
        order = Window.partitionBy("id").orderBy(F.desc("sim"), "nn_id")
        found = materialize(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k), "neighbours")
    release(*sides)
    return found


def first_neighbour(queries: DataFrame, candidates: DataFrame, kernel: Kernel, floor: float | None = None, id_col: str = "id") -> DataFrame:
    """(id, nn_id, sim) of every query; without a neighbour nn_id is null and sim ``floor``."""
    found = nearest(queries, candidates, 1, kernel, id_col).select("id", "nn_id", "sim")
    d = queries.select(F.col(id_col).alias("id")).join(found, "id", "left")
    return d if floor is None else d.withColumn("sim", F.greatest(F.coalesce("sim", F.lit(floor)), F.lit(floor)))


def mean_neighbour_distance(queries: DataFrame, candidates: DataFrame, k: int, id_col: str = "id", approximate: bool = False) -> DataFrame:
    """(id, knn_dist): mean Euclidean distance to the ``k`` nearest others; ``approximate``: among those
    that random projections bring together (see ``vector_neighbours``)."""
    from clearset.operators import vector_neighbours as vn

    q = queries.where("vec IS NOT NULL")
    c = q if candidates is queries else candidates.where("vec IS NOT NULL")
    found = vn.nearest(q, c, k, euclidean, vn.projected, id_col) if approximate else nearest(q, c, k, euclidean, id_col)
    return found.groupBy("id").agg(F.avg(-F.col("sim")).alias("knn_dist"))


def dup_scores(df: DataFrame, bits: int = 64) -> DataFrame:
    """(id, nn_id, dup_score): fused nearest neighbour of (id, hash, vec), or by hash alone
    without vectors (see ``hash_neighbours``); clipped to 0 .. 1, and 0 without a hash or vector."""
    if "vec" in df.columns:
        seen = df.where("vec IS NOT NULL")
        found = df.select("id").join(first_neighbour(seen, seen, fused(bits)), "id", "left")
    else:
        from clearset.operators.hash_neighbours import nearest_hash

        found = nearest_hash(df, df, bits=bits).withColumn("sim", 1 - F.col("dist") / bits)
    return found.select("id", "nn_id", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce("sim", F.lit(0.0)))).alias("dup_score"))


def label_conflicts(neighbours: DataFrame, labels: DataFrame, threshold: float) -> DataFrame:
    """(id) of the rows that are, at ``threshold`` or more, the nearest of a row with another
    label, or have such a nearest row: both ends are flagged."""
    own = labels.select(F.col("id"), F.col("label").alias("own"))
    other = labels.select(F.col("id").alias("nn_id"), F.col("label").alias("other"))
    bad = neighbours.where(F.col("dup_score") >= threshold).join(own, "id").join(other, "nn_id").where("own <> other")
    return bad.select("id").union(bad.select("nn_id")).distinct()


def zero_shot(df: DataFrame, prompts: DataFrame, scale: float = 1.0) -> DataFrame:
    """(id, zero_shot): 1 minus the softmax mass of the positive prompts, 0.5 without a vector.
    ``prompts`` (prompt, positive, vec) is a short list of fixed size."""
    rows = prompts.orderBy("prompt").collect()
    def dot(v: list[float]) -> Column:
        return F.aggregate(F.zip_with("vec", F.array(*[F.lit(float(x)) for x in v]), lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)

    e = [(bool(r["positive"]), F.exp(scale * dot(r["vec"]))) for r in rows]
    total = sum((x for _, x in e[1:]), e[0][1])
    good = sum((x for p, x in e if p), F.lit(0.0))
    return df.select("id", F.when(F.col("vec").isNull(), F.lit(0.5)).otherwise(1 - good / total).alias("zero_shot"))
