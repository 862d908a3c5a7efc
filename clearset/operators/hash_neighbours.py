"""Exact nearest neighbours of hashes by a radius that grows, without comparing all with all.

In round s hashes meet where a band agrees but for s bits.  A pair at distance d has a band that
differs in at most d // bands bits, so after round s every neighbour within bands * (s + 1) - 1 has
been met: rows whose best lies within that are settled and leave.  What is left after the last
round has no near neighbour at all and goes to the blocks of ``similarity.nearest``, and so does every
row where the bands are too common for rounds to pay.
"""

from __future__ import annotations

from itertools import combinations
from math import comb, log2

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearset.operators import similarity
from clearset.operators.bands import HEAVY, hamming, is_wide, meet, nearest_other
from clearset.storage import materialize, release

#: Rounds of the growing radius, and keys that a hash may have in one: a round that would take more is left
#: out, and so are all where bands would compare more than this share of all pairs (see ``search_rounds``).
ROUNDS, KEYS, SHARE = 3, 512, 0.25


def _bands(bits: int, words: int, width: int) -> list[tuple[int, int, int]]:
    """(word, lowest bit, bits) of bands of about ``width`` bits that cover all words."""
    of_word = min(bits, 64)
    parts = max(1, min(of_word, round(of_word / width)))
    edges = [of_word * i // parts for i in range(parts + 1)]
    return [(w, edges[i], edges[i + 1] - edges[i]) for w in range(words) for i in range(parts)]


def _banded(hashes: DataFrame, bands: list[tuple[int, int, int]], wide: bool, flips: int) -> DataFrame:
    """``hashes`` (h and more) with a row for each band and key that differs from the hash's own in
    exactly ``flips`` bits."""

    def keys(number: int, word: int, low: int, n: int) -> Column:
        own = F.shiftrightunsigned(F.get("h", F.lit(word)) if wide else F.col("h"), low)
        own = own.bitwiseAND(F.lit((1 << n) - 1)) if n < 64 else own
        masks = [sum(1 << i for i in c) for c in combinations(range(n), flips)]
        masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in masks]).cast("array<bigint>")
        return F.transform(masks, lambda m: F.struct(F.lit(number).alias("band"), m.bitwiseXOR(own).alias("key")))

    every = F.flatten(F.array(*[keys(i, *b) for i, b in enumerate(bands)]))
    return hashes.select("*", F.explode(every).alias("__k")).select(*hashes.columns, "__k.*")


def by_radius(search: DataFrame, classes: DataFrame, bits: int, rounds: int = ROUNDS, width: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(settled, rest) of the hashes ``search`` (h): (h, nn, dist) of those whose nearest different
    hash among ``classes`` (h, first: its smallest id) is found, and (h) of the others."""
    wide = is_wide(search, "h")
    bands = _bands_for(classes, bits, width)
    id_type = classes.schema["first"].dataType.simpleString()
    hash_type = search.schema["h"].dataType.simpleString()
    right = _banded(classes, bands, wide, 0)

    def light(a: DataFrame, b: DataFrame) -> DataFrame:
        # both sides were exploded from small tables: their size on disk says nothing, so never broadcast
        near = a.join(b.withColumnRenamed("h", "other").hint("merge"), ["band", "key"]).where(F.col("h") != F.col("other"))
        return near.select("h", hamming(F.col("h"), F.col("other"), wide).cast("int").alias("dist"), F.col("first").alias("nn"))

    open_ = materialize(search.select("h", F.lit(None).cast("int").alias("dist"), F.lit(None).cast(id_type).alias("nn")), "open-hashes")
    settled = open_.where("false")
    for s in range(rounds):
        if s > min(n for *_, n in bands) or open_.isEmpty():
            break
        met = meet(_banded(open_.select("h"), bands, wide, s), right, light, nearest_other, f"h {hash_type}, dist int, nn {id_type}")
        best = met.unionByName(open_.where("dist IS NOT NULL")).groupBy("h").agg(F.min(F.struct("dist", "nn")).alias("b"))
        best = open_.select("h").join(best, "h", "left").select("h", "b.dist", "b.nn")
        last, now = open_, materialize(best, "hash-round")
        release(last)
        near = F.coalesce(F.col("dist") < len(bands) * (s + 1), F.lit(False))
        settled, open_ = settled.unionByName(now.where(near)) if s else now.where(near), now.where(~near)
        if s + 1 < rounds:
            open_ = materialize(open_, "open-hashes")
    return settled.select("h", "nn", "dist"), open_.select("h")


def _bands_for(classes: DataFrame, bits: int, width: int | None) -> list[tuple[int, int, int]]:
    words = -(-bits // 64) if is_wide(classes, "h") else 1
    return _bands(bits, words, width or min(16, max(4, round(log2(classes.count() + 1)))))


def search_rounds(classes: DataFrame, bits: int, rounds: int = ROUNDS, width: int | None = None) -> int:
    """Rounds that pay: none where equal bands bring together so many of the hashes ``classes`` (h) that
    comparing all of them, which needs no shuffle, is the smaller work (flat bands of wide hashes), and
    none in which a hash would be more than KEYS rows."""
    bands = _bands_for(classes, bits, width)
    while rounds and sum(comb(n, rounds - 1) for *_, n in bands) > KEYS:
        rounds -= 1
    met = _banded(classes.select("h"), bands, is_wide(classes, "h"), 0).groupBy("band", "key").agg(F.count("*").cast("double").alias("n"))
    pairs = met.agg(F.sum(F.col("n") * F.col("n"))).first()[0] or 0.0
    return 0 if pairs > SHARE * max(HEAVY, classes.count()) ** 2 else rounds


def nearest_hash(queries: DataFrame, candidates: DataFrame, id_col: str = "id", hash_col: str = "hash", bits: int = 64, rounds: int = ROUNDS, width: int | None = None) -> DataFrame:
    """(id, nn_id, dist) of each query: the nearest candidate with another id, the smallest id among
    equals; nulls for a null hash, or where there is none.  ``bits``: of all words of a hash."""
    c = candidates.where(F.col(hash_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(hash_col).alias("h"))
    first_two = c.withColumn("n", F.row_number().over(Window.partitionBy("h").orderBy("id"))).where("n <= 2")  # cut before the shuffle
    classes = first_two.groupBy("h").agg(F.min("id").alias("first"), F.max("id").alias("second"))
    classes = materialize(classes, "hash-classes")
    q = queries.select(F.col(id_col).alias("id"), F.col(hash_col).alias("h"))
    same = q.where("h IS NOT NULL").join(classes, "h", "left")
    other = F.when(F.col("first") != F.col("id"), F.col("first")).otherwise(F.when(F.col("second") != F.col("id"), F.col("second")))
    rows = materialize(same.select("id", "h", other.alias("nn_id")), "hash-queries")
    unique = rows.where("nn_id IS NULL").select("id", "h")
    settled, rest = by_radius(unique.select("h").distinct(), classes.select("h", "first"), bits, search_rounds(classes, bits, rounds, width), width)
    far = unique.join(rest, "h", "left_semi").select("id", F.col("h").alias("hash"))
    far = similarity.first_neighbour(far, classes.select(F.col("first").alias("id"), F.col("h").alias("hash")), similarity.hamming_kernel)
    parts = [
        rows.where("nn_id IS NOT NULL").select("id", "nn_id", F.lit(0).alias("dist")),
        unique.join(settled, "h").select("id", F.col("nn").alias("nn_id"), "dist"),
        far.select("id", "nn_id", (-F.col("sim")).cast("int").alias("dist")),
    ]
    out = q.where("h IS NULL").select("id", F.lit(None).cast(parts[0].schema["nn_id"].dataType).alias("nn_id"), F.lit(None).cast("int").alias("dist"))
    for p in parts:
        out = out.unionByName(p)
    return out
