"""Hashes that meet where a band of their bits agrees, with hot bands cut into a grid.

A hash is a long, or an array of longs of one length (256 bits: four words).  Rows that share a band
key meet in an equi-join.  Keys that very many hashes share (flat images, empty bands) are found
by counting: their hashes are dealt to parts of about ``CELL``, and each pair of parts is a group
of its own, which a task compares in numpy, strip by strip.  So no task holds a hot key, and no
pair is lost.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clearset.storage import checked_broadcast, materialize, release

#: Hashes with one band key beyond which it counts as hot, and hashes of one part of it.
HEAVY, CELL = 4096, 4096
#: Rows of a part that are compared with the other one at once.
STRIP = 256


def hamming(a: Column, b: Column, wide: bool = False) -> Column:
    """Differing bits of two hashes; ``wide``: arrays of 64-bit words of one length."""
    if wide:
        return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    return F.bit_count(a.bitwiseXOR(b))


def is_wide(df: DataFrame, hash_col: str = "hash") -> bool:
    return isinstance(df.schema[hash_col].dataType, T.ArrayType)


def words_of(hashes: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    """(known, words) of hashes that are longs or arrays of longs: one row a hash, zeros where null."""
    known = np.array([h is not None and not (np.isscalar(h) and pd.isna(h)) for h in hashes], bool)
    live = [np.atleast_1d(np.asarray(h, dtype=np.int64)) for h in hashes[known]]
    words = np.zeros((len(hashes), len(live[0]) if live else 1), np.int64)
    if live:
        words[known] = np.stack(live)
    return known, words.view(np.uint64)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = np.zeros((len(a), len(b)), np.int32)
    for w in range(a.shape[1]):
        d += np.bitwise_count(a[:, w][:, None] ^ b[:, w][None, :])
    return d


def pairs_within(most: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """(ha, hb, dist) of the different hashes of two parts within a distance."""

    def compare(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(b):
            x, y = words_of(a["h"])[1], words_of(b["h"])[1]
            for at in range(0, len(x), STRIP):
                d = _distances(x[at : at + STRIP], y)
                i, j = np.nonzero((d > 0) & (d <= most))
                out.append(pd.DataFrame({"ha": a["h"].to_numpy()[at + i], "hb": b["h"].to_numpy()[j], "dist": d[i, j]}))
        return pd.concat(out) if out else pd.DataFrame({"ha": [], "hb": [], "dist": []}, dtype=object)

    return compare


def nearest_other(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """(h, dist, nn) for each hash of the first part: the nearest different hash of the second, by
    the smallest id among equals."""
    out = []
    if len(a) and len(b):
        b = b.sort_values("first", ignore_index=True)
        x, y = words_of(a["h"])[1], words_of(b["h"])[1]
        for at in range(0, len(x), STRIP):
            d = _distances(x[at : at + STRIP], y)
            d[d == 0] = 1 << 20
            best = d.argmin(1)
            dist = d[np.arange(len(d)), best]
            some = dist < 1 << 20
            out.append(pd.DataFrame({"h": a["h"].to_numpy()[at : at + STRIP][some], "dist": dist[some], "nn": b["first"].to_numpy()[best[some]]}))
    return pd.concat(out) if out else pd.DataFrame({"h": [], "dist": [], "nn": []}, dtype=object)


def meet(left: DataFrame, right: DataFrame, light: Callable[[DataFrame, DataFrame], DataFrame], cells: Callable, schema: str, triangle: bool = False) -> DataFrame:
    """What ``light`` makes of two sides (band, key, h and more) by a join on (band, key), together
    with what ``cells`` makes of each pair of parts of a hot key.  Both give ``schema``.
    ``triangle``: both sides are the same, so that each pair of parts meets once."""
    keys = ["band", "key"]

    def hot(side: DataFrame, parts: str) -> DataFrame:
        n = side.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > HEAVY)
        return n.select(*keys, F.ceil(F.col("n") / CELL).cast("int").alias(parts))

    if triangle:
        found = hot(left, "left_parts").withColumn("right_parts", F.col("left_parts"))
    else:
        found = hot(left, "left_parts").join(hot(right, "right_parts"), keys, "full").fillna(1, ["left_parts", "right_parts"])
    heavy = materialize(found, "hot-bands")
    if heavy.isEmpty():
        release(heavy)
        return light(left, right)
    heavy = checked_broadcast(heavy)
    few = light(left.join(heavy, keys, "left_anti"), right.join(heavy, keys, "left_anti"))
    part = lambda n: F.pmod(F.xxhash64(F.lit("part"), "h"), F.col(n)).cast("int")
    l = left.join(heavy, keys).withColumn("cl", part("left_parts"))
    l = l.withColumn("cr", F.explode(F.sequence(F.col("cl") if triangle else F.lit(0), F.col("right_parts") - 1)))
    r = right.join(heavy, keys).withColumn("cr", part("right_parts"))
    r = r.withColumn("cl", F.explode(F.sequence(F.lit(0), F.col("cr") if triangle else F.col("left_parts") - 1)))
    r = r.select(*[F.col(c).alias(c) for c in r.columns])  # columns of its own, as both come from one table
    cell = [*keys, "cl", "cr"]
    return few.unionByName(l.groupBy(*cell).cogroup(r.groupBy(*cell)).applyInPandas(lambda a, b: cells(a, b), schema))
