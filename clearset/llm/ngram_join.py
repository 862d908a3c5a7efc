"""Jaccard self-join of word shingles by vertical partitioning.

All shingles stand in one global order: those not known to be frequent first, by hash, the
frequent ones last.  Two sets of the wanted similarity share at least SHARED shingles within
their prefixes in any such order, so only prefixes are exchanged to find candidates.

The order is then cut into fragments: each set becomes one segment per fragment, partial
overlaps are counted fragment by fragment, and the sums per pair decide.

* Sets that are equal are one class; only classes are compared.  Pairs whose sizes alone rule
  the similarity out are never formed.
* Prefix shingles that few classes hold, no more than a frequent shingle has to exceed, give their
  pairs directly.
* Classes with a prefix shingle that many hold consist of little but frequent shingles.  All of
  their shingles are counted among them, and they get a second prefix, of their rarest ones.
* Second-prefix shingles that many classes still hold (groups of near copies) would give pairs
  by the square.  Each of their classes meets LEADERS leaders of the shingle instead.
* What leaders and direct pairs link is a part.  A frequent shingle whose classes are all in one
  part is settled.  The classes of the others are compared by blocks of bounded size, fragment
  by fragment inside a task, where classes of one large part meet those of others only; a task
  emits no more links than it takes to connect what is linked.

Links join into components; every document gets the smallest doc_id of its component.

Defined cases: a null text, or one without words, has an empty set and links with nothing;
a text of fewer words than a shingle has its whole sequence as its one shingle; equal
hashes are the same shingle (64 bits); rows that repeat a doc_id are documents of their
own under the same id; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearset.llm.shingles import set_key, sets_of
from clearset.llm.text import give_back, row_key, small_batches
from clearset.operators.components import connected_components
from clearset.storage import checked_broadcast, materialize, release

#: Shingles are counted over the corpus where prefixes take theirs from: the low end of the
#: hash range, wider by this factor than the share of a set that a prefix is.
COUNTED = 1.6
#: Common shingles that prefixes are long enough to promise (all of a set, if it has fewer).
SHARED = 4
#: Frequent shingles are broadcast: at most this many by construction of their threshold, which is looked
#: for among counts up to COUNTS.
FREQUENT, COUNTS = 1 << 20, 4096
#: Classes that hold a shingle of a first or second prefix for it to give pairs directly (of a first one as
#: many as a frequent shingle has to exceed, if that is more); leaders of any other one.
FEW, FEW_AGAIN, LEADERS = 16, 48, 2
FRAGMENTS = 8
#: Shingles and classes of one block of a cluster, and columns that a task multiplies at once.
BLOCK_SHINGLES, BLOCK_ROWS, COLUMNS = 1 << 18, 2048, 1024
#: Rows of a block that are compared at once.
STRIP = 256


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def needed(n: np.ndarray | int, percent: int):
    """Least overlap of a set of ``n`` with any set of the wanted similarity."""
    return -(-percent * n // 100)


def fits(na, nb, percent: int):
    """Whether different sets of ``na`` and ``nb`` can have the wanted similarity (columns or arrays)."""
    low, high = (F.least(na, nb), F.greatest(na, nb)) if isinstance(na, Column) else (np.minimum(na, nb), np.maximum(na, nb))
    return (100 * low >= percent * high) & ((low < high) | (100 * (low - 1) >= percent * (low + 1)))


def counted_below(percent: int) -> np.uint64:
    """Hashes below this one are counted."""
    return np.uint64(min(255, int(256 * COUNTED * (100 - percent) / 100) + 1) << 56)


def threshold(counts: DataFrame) -> int:
    """The least number of documents, FEW at least, that no more than FREQUENT of the shingles ``counts``
    (n, of more than FEW documents) exceed."""
    held = counts.groupBy(F.least("n", F.lit(COUNTS)).alias("n")).agg(F.count("*").alias("shingles"), F.sum("n").alias("rows")).orderBy(F.desc("n")).collect()  # COUNTS rows at most
    above = 0
    for r in held:
        above += r["shingles"]
        if above > FREQUENT:
            # of those beyond COUNTS at most rows / (rows / FREQUENT) pass
            return r["n"] if r["n"] < COUNTS else max(COUNTS, r["rows"] // FREQUENT)
    return FEW


def frequent_shingles(docs: DataFrame, percent: int, words: int) -> tuple[DataFrame, int]:
    """((shingle) of the counted shingles that are frequent, the number of documents that each exceeds)."""
    top = counted_below(percent)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = [own[: np.searchsorted(own, top)] for _, sets in sets_of(batch.column(0), words) for own in sets]
            if low:
                found, n = np.unique(np.concatenate(low), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(signed(found)), pa.array(n.astype(np.int64))], ["shingle", "n"])

    counts = docs.select("text").mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") > FEW)
    counts = materialize(counts, "shingle-counts")
    most = threshold(counts)
    frequent = materialize(counts.where(F.col("n") > most).select("shingle"), "frequent-shingles")
    release(counts)
    return frequent, most


def shingle_classes(docs: DataFrame, frequent: DataFrame, percent: int, words: int) -> DataFrame:
    """(doc_id, rk, n, v, prefix) of each document; v: the class of its set."""
    last = docs.sparkSession.sparkContext.broadcast(np.sort(np.array([r[0] for r in frequent.toLocalIterator()], np.int64).view(np.uint64)))
    top = counted_below(percent)

    def prefix(own: np.ndarray) -> np.ndarray:
        size = min(len(own), len(own) - needed(len(own), percent) + SHARED)
        common = last.value
        late = np.zeros(len(own), bool)
        low = own[: np.searchsorted(own, top)]
        if len(common) and len(low):
            at = np.minimum(np.searchsorted(common, low), len(common) - 1)
            late[: len(low)] = common[at] == low
        return signed(np.concatenate([own[~late][:size], own[late]])[:size])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            for first, sets in sets_of(batch.column(2), words):
                prefixes = [prefix(own) for own in sets]
                ends = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(sets)),
                        batch.column(1).slice(first, len(sets)),
                        pa.array(np.array([len(own) for own in sets], np.int64)),
                        pa.array([set_key(own) for own in sets], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(prefixes))),
                    ],
                    ["doc_id", "rk", "n", "v", "prefix"],
                )
        give_back()

    return docs.select("doc_id", "rk", "text").mapInArrow(build, "doc_id long, rk long, n long, v long, prefix array<long>")


def segments(docs: DataFrame, words: int) -> DataFrame:
    """(v, fragment, shingles) of the sets of (v, text), cut at fixed places of the order."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        bounds = (np.arange(1, FRAGMENTS, dtype=np.uint64)) << np.uint64(64 - FRAGMENTS.bit_length() + 1)
        for batch in batches:
            for first, sets in sets_of(batch.column(1), words):
                parts = [x for own in sets for x in np.split(own, np.searchsorted(own, bounds))]
                ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
                v = np.repeat(batch.column(0).slice(first, len(sets)).to_numpy(zero_copy_only=False), FRAGMENTS)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(v, pa.int64()),
                        pa.array(np.tile(np.arange(FRAGMENTS, dtype=np.int32), len(sets))),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(np.concatenate(parts)))),
                    ],
                    ["v", "fragment", "shingles"],
                )
        give_back()

    return docs.select("v", "text").mapInArrow(cut, "v long, fragment int, shingles array<long>")


def verified_pairs(pairs: DataFrame, segs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, na, nb) whose overlap suffices: partial counts by fragment, summed."""
    left = segs.select(F.col("v").alias("a"), "fragment", F.col("shingles").alias("sa"))
    right = segs.select(F.col("v").alias("b"), "fragment", F.col("shingles").alias("sb"))
    part = pairs.join(left, "a").join(right, ["b", "fragment"])
    part = part.select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).alias("n"))
    total = part.groupBy("a", "b", "na", "nb").agg(F.sum("n").alias("n"))
    return total.where(100 * F.col("n") >= percent * (F.col("na") + F.col("nb") - F.col("n"))).select("a", "b")


def block_links(percent: int):
    """Task function: links between classes of different parts in two blocks (or one), as a
    forest; rows (block, v, shingles) and, where there are several, fragment and part."""

    def link(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        give_back()
        _, i, j = key
        ids, at, row = np.unique(pdf["v"].to_numpy(), return_index=True, return_inverse=True)
        own_block = pdf["block"].to_numpy()[at]
        part = np.unique(pdf["part"].to_numpy()[at], return_inverse=True)[1] if "part" in pdf else np.arange(len(ids))
        shingles, lens = pdf["shingles"].to_numpy(), np.fromiter(map(len, pdf["shingles"]), np.int64, len(pdf))
        sizes = np.bincount(row, lens, len(ids)).astype(np.int64)
        fragments = pdf.groupby("fragment").indices.values() if "fragment" in pdf else [np.arange(len(pdf))]
        left, right = np.flatnonzero(own_block == i), np.flatnonzero(own_block == j)
        out: list[tuple[int, int]] = []
        if fits(np.unique(sizes[left])[:, None], np.unique(sizes[right])[None, :], percent).any():
            place = np.zeros((2, len(ids)), np.int64)
            place[0, left], place[1, right] = np.arange(len(left)), np.arange(len(right))
            overlap = np.zeros((len(left), len(right)), np.float32)
            for rows in fragments:
                add_overlaps(overlap, np.concatenate(shingles[rows]).astype(np.int64), np.repeat(row[rows], lens[rows]), own_block, (i, j), place)
            parent = list(range(len(ids)))

            def root(k: int) -> int:
                while parent[k] != k:
                    parent[k] = parent[parent[k]]
                    k = parent[k]
                return k

            for first in range(0, len(left), STRIP):
                rows = left[first : first + STRIP]
                own = overlap[first : first + STRIP].astype(np.float64)
                union = sizes[rows][:, None] + sizes[right][None, :] - own
                x, y = np.nonzero((100 * own >= percent * union) & (part[rows][:, None] != part[right][None, :]))
                for p, q in zip(rows[x].tolist(), right[y].tolist()):
                    a, b = root(int(part[p])), root(int(part[q]))
                    if a != b:
                        parent[a] = b
                        out.append((p, q))
        pairs = np.array(out, np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": ids[pairs[:, 0]], "b": ids[pairs[:, 1]]})

    return link


def add_overlaps(overlap: np.ndarray, tokens: np.ndarray, owner: np.ndarray, block: np.ndarray, key: tuple[int, int], place: np.ndarray) -> None:
    """Add to ``overlap`` the shingles of one fragment that a left and a right set share."""
    code = np.unique(tokens, return_inverse=True)[1]
    order = np.argsort(code, kind="stable")
    # shingles that only one of the sets holds count for no pair
    order = order[np.bincount(code)[code[order]] > 1]
    code, owner = np.unique(code[order], return_inverse=True)[1], owner[order]
    for at in range(0, int(code.max()) + 1 if len(code) else 0, COLUMNS):
        lo, hi = np.searchsorted(code, [at, at + COLUMNS])
        sides = []
        for k, side in enumerate(key):
            m = np.zeros((overlap.shape[k], COLUMNS), np.float32)
            own = block[owner[lo:hi]] == side
            m[place[k, owner[lo:hi][own]], code[lo:hi][own] - at] = 1
            sides.append(m)
        overlap += sides[0] @ sides[1].T


def in_blocks(member: DataFrame) -> DataFrame:
    """(component, v, part, block, i, j) of the classes (v, n, part) of clusters, one row for each
    pair of blocks i <= j that a class meets in.

    A part of half a block or more has blocks of its own, which do not meet each other; all
    smaller ones share blocks.  Neither the shingles nor the classes of a block grow with its
    cluster.  Even block numbers are shared ones, odd ones belong to a part.  Without a column
    ``part`` each class is one."""
    if "part" not in member.columns:
        member = member.withColumn("part", F.col("v"))
    size = F.greatest(F.sum("n") / BLOCK_SHINGLES, F.count("*") / BLOCK_ROWS)
    parts = member.groupBy("component", "part").agg(size.alias("size"))
    large = materialize(parts.where("size >= 0.5").select("component", "part", F.ceil("size").cast("int").alias("own")), "large-parts")
    shared = parts.where("size < 0.5").groupBy("component").agg(F.ceil(F.sum("size")).cast("int").alias("shared"))
    # numbers of the blocks of each large part: one row for each of them, far fewer than classes
    before = F.coalesce(F.sum("own").over(Window.partitionBy("component").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = large.withColumn("first", before.cast("int"))
    total = numbered.groupBy("component").agg(F.sum("own").cast("int").alias("owned"))
    d = member.join(numbered, ["component", "part"], "left").join(shared, "component", "left").join(total, "component", "left")
    d = d.withColumn("shared", F.coalesce("shared", F.lit(0))).withColumn("owned", F.coalesce("owned", F.lit(0)))
    pick = lambda n: F.pmod(F.xxhash64("v"), n).cast("int")
    mine = 2 * (F.col("first") + pick(F.col("own"))) + 1
    d = d.withColumn("block", F.when(F.col("own").isNull(), 2 * pick(F.greatest("shared", F.lit(1)))).otherwise(mine))
    # a block meets all shared ones and those of other parts
    upto = lambda n, odd: F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda k: 2 * k + odd)).otherwise(F.array().cast("array<int>"))
    foreign = F.filter(upto(F.col("owned"), 1), lambda k: F.col("own").isNull() | (k < 2 * F.col("first") + 1) | (k >= 2 * (F.col("first") + F.col("own"))))
    d = d.withColumn("with", F.explode(F.concat(upto(F.col("shared"), 0), foreign)))
    return d.select("component", "v", "part", "block", F.least("block", "with").alias("i"), F.greatest("block", "with").alias("j"))


def parts_of(links: DataFrame) -> DataFrame:
    """(v, part) of the classes that ``links`` (a, b) join."""
    return connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))).select(F.col("node").alias("v"), F.col("component").alias("part"))


def second_prefixes(classes: DataFrame, segs: DataFrame, percent: int) -> DataFrame:
    """(shingle, v, n, df) of the rarest shingles of each class (v, n), counted among them all."""
    flat = segs.join(classes, "v").select("v", "n", F.explode("shingles").alias("shingle"))
    counts = flat.groupBy("shingle").agg(F.count("*").alias("df"))
    rank = F.row_number().over(Window.partitionBy("v").orderBy("df", "shingle"))
    size = F.col("n") - F.ceil(F.col("n") * percent / 100) + SHARED
    return flat.join(counts, "shingle").withColumn("rank", rank).where((F.col("rank") <= size) & (F.col("df") > 1)).select("shingle", "v", "n", "df")


def direct_pairs(few: DataFrame, percent: int) -> DataFrame:
    """Candidates (a, b, na, nb) of prefix shingles (shingle, v, n) that few classes hold."""
    a = few.select("shingle", F.col("v").alias("a"), F.col("n").alias("na"))
    b = few.select("shingle", F.col("v").alias("b"), F.col("n").alias("nb"))
    met = a.join(b, "shingle").where((F.col("a") < F.col("b")) & fits(F.col("na"), F.col("nb"), percent))
    met = met.groupBy("a", "b", "na", "nb").agg(F.count("*").alias("met"))
    # a pair that shares no frequent shingle shares enough of these, or it is not similar
    enough = F.least(F.lit(SHARED), F.ceil(F.greatest("na", "nb") * percent / 100))
    return met.where(F.col("met") >= enough).select("a", "b", "na", "nb")


def leader_pairs(many: DataFrame, percent: int) -> DataFrame:
    """Candidates (a, b, na, nb) of the frequent prefix shingles (shingle, v, n): each class with
    the leaders of its shingles.  The leader is b, whose set is joined last."""
    lead = [F.min(F.struct(F.xxhash64(F.lit(k), "v").alias("h"), "v", "n")).alias(f"l{k}") for k in range(LEADERS)]
    leaders = many.groupBy("shingle").agg(*lead).select("shingle", F.explode(F.array_distinct(F.array(*[f"l{k}" for k in range(LEADERS)]))).alias("l"))
    met = many.join(leaders, "shingle").select(F.col("v").alias("a"), F.col("l.v").alias("b"), F.col("n").alias("na"), F.col("l.n").alias("nb"))
    return met.where((F.col("a") != F.col("b")) & fits(F.col("na"), F.col("nb"), percent)).distinct()


def links(shared: DataFrame, texts_of, percent: int, few: int = FEW) -> DataFrame:
    """Enough links (a, b) to connect all classes that are linked; ``shared``: the table of prefix
    shingles (shingle, v, n, df), ``texts_of``: a function from classes (v) to their segments,
    ``few``: classes that hold a shingle for it to give pairs directly.  Prefixes take shingles of up to
    that many first, so a class with a more common one consists of little else."""
    first = materialize(direct_pairs(shared.where(F.col("df") <= few), percent), "candidates")
    hot = materialize(shared.where(F.col("df") > few).select("v", "n").distinct(), "frequent-classes")
    release(shared)
    wanted = first.select(F.col("a").alias("v")).union(first.select("b")).union(hot.select("v")).distinct()
    segs = materialize(texts_of(wanted), "segments")
    again = materialize(second_prefixes(hot, segs, percent), "second-prefixes")
    release(hot)
    many = materialize(again.where(F.col("df") > FEW_AGAIN).select("shingle", "v", "n"), "frequent-prefixes")
    pairs = first.unionByName(direct_pairs(again.where(F.col("df") <= FEW_AGAIN), percent)).unionByName(leader_pairs(many, percent))
    pairs = materialize(pairs.distinct(), "all-candidates")
    release(first, again)
    direct = materialize(verified_pairs(pairs, segs, percent), "direct-links")
    release(pairs)

    linked = materialize(parts_of(direct), "parts")
    held = many.join(linked, "v", "left").withColumn("part", F.coalesce("part", "v"))
    held = materialize(held, "frequent-parts")
    release(many, linked)
    # shingles whose classes are all in one part are settled
    open_ = held.groupBy("shingle").agg(F.min("part").alias("least"), F.max("part").alias("most")).where("least <> most").select("shingle")
    rest = materialize(held.join(open_, "shingle"), "open-prefixes")
    release(held)
    # parts and shingles are the two kinds of nodes: even and odd numbers
    edges = rest.select(F.expr("shiftleft(xxhash64(1, part), 1)").alias("u"), F.expr("shiftleft(xxhash64(2, shingle), 1) | 1L").alias("v")).distinct()
    clusters = connected_components(edges).select(F.col("node").alias("u"), "component")
    member = rest.select("v", "n", "part", F.expr("shiftleft(xxhash64(1, part), 1)").alias("u")).distinct()
    member = materialize(member.join(clusters, "u").select("component", "v", "n", "part"), "clusters")
    release(rest)
    spread = in_blocks(member).join(segs, "v")
    met = materialize(spread.groupBy("component", "i", "j").applyInPandas(block_links(percent), "a long, b long"), "block-links")
    release(segs, member)
    return direct.unionByName(met)


def near_duplicate_rows(docs: DataFrame, percent: int = 80, words: int = 5) -> DataFrame:
    """(doc_id, rk, n_shingles, component, component_id) of each row of ``docs`` (doc_id, text).

    Two documents link when the Jaccard similarity of their shingle sets is at least
    ``percent`` in a hundred; component_id is the smallest doc_id that links reach.
    ``component`` tells components apart whatever ids repeat or lack; it is null for rows
    that link with no other.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key(F.col("doc_id"), F.col("text")).alias("rk"), "text")
    small_batches(docs.sparkSession)
    frequent, most = frequent_shingles(docs, percent, words)
    sets = materialize(shingle_classes(docs, frequent, percent, words).withColumn("uid", F.monotonically_increasing_id()), "shingle-sets")
    release(frequent)
    # equal sets are one class, told apart by 64 bits; its first row stands for it
    classes = sets.where("n > 0").groupBy("v").agg(F.min("doc_id").alias("doc"), F.min("uid").alias("uid"), F.count("*").alias("size"))
    classes = materialize(classes, "shingle-classes")
    repeats = classes.where("size > 1").select("v", F.col("uid").alias("first"))
    rows = materialize(sets.select("doc_id", "rk", "n", "v", "uid"), "shingle-rows")
    others = materialize(rows.where("n > 0").join(repeats, "v").where("uid <> first").select("uid"), "other-copies")
    able = sets.where(100 * F.col("n") >= percent * (F.col("n") + 1)).join(checked_broadcast(others), "uid", "left_anti")
    prefixes = able.select("v", "n", F.explode("prefix").alias("shingle"))
    # shingles of several classes grow with the corpus: never broadcast
    held = materialize(prefixes.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1"), "held-shingles")
    shared = materialize(prefixes.join(held.hint("merge"), "shingle").select("shingle", "v", "n", "df"), "shared-prefixes")
    release(held, sets)

    def segments_of(wanted: DataFrame) -> DataFrame:
        first = materialize(wanted.join(classes.select("v", "uid"), "v").join(rows.select("uid", "rk"), "uid").select("v", "rk"), "compared-classes")
        # rows that are equal share a key: one of them stands for the class
        return segments(docs.join(checked_broadcast(first), "rk").dropDuplicates(["v"]), words)

    found = links(shared, segments_of, percent, most)
    linked = materialize(parts_of(found), "components")
    named = classes.select("v", "doc", "size").join(linked, "v", "left")
    named = named.where("size > 1 OR part IS NOT NULL").select("v", "doc", F.coalesce("part", "v").alias("component"))
    least = named.groupBy("component").agg(F.min("doc").alias("component_id"))
    named = materialize(named.join(least, "component").select("v", "component", "component_id"), "components-of-classes")
    release(others, linked, classes)
    out = rows.join(checked_broadcast(named), (rows["v"] == named["v"]) & (rows["n"] > 0), "left")
    return out.select("doc_id", "rk", F.col("n").alias("n_shingles"), "component", F.coalesce("component_id", "doc_id").alias("component_id"))


def near_duplicate_components(docs: DataFrame, percent: int = 80, words: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id) of ``near_duplicate_rows``."""
    return near_duplicate_rows(docs, percent, words).select("doc_id", "n_shingles", "component_id")


def op10_ngram_join(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicate_components(docs, percent=90, words=3)


OP10_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, md5(array_to_string(w[p:p + 2], ' ')) AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS p FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT a, b FROM o JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * k >= 90 * (x.n + y.n - k)),
r AS (SELECT a AS doc_id, b AS reach FROM l UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.reach = l.a)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(w.doc_id, coalesce(min(r.reach), w.doc_id)) AS component_id
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN r ON w.doc_id = r.doc_id GROUP BY w.doc_id
"""
