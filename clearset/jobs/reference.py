"""Cross-set scores that are kept up while test rows arrive, against a training set fitted once.

``fit`` writes what the training set gives to every later row: its vectors, its different hashes, its
mean vector, the cumulative shares of its signals and the scale of its hash distances.  ``absorb``
adds a part of the test rows to a log: the signals of the new rows, and rows seen before whose nearest
hash is now a new one.  A log is a folder of Parquet with one folder a part; merging it takes the
smallest distance of each id, which does not depend on how rows were cut into parts or on parts
that are absorbed again.  ``current_scores`` therefore equals ``scoring.cross_set_scores`` of all
rows so far, and costs one ranking of their signals; neighbours are searched once a row.
``fitted_scores`` ranks against the training set instead, so that the off-topic score of a row stands
from the moment it arrives.

Defined cases: ids have to be unique over all parts; a row without a vector has no off-topic score, one
without a hash no duplicate score; an empty part changes nothing; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clearset.functions import scores
from clearset.operators import hash_neighbours, outliers, ranking, similarity
from clearset.storage import materialize, path_exists, release

SIGNALS = ("centroid_dist", "text_length", "knn_dist")
#: Digits to which signals are compared with those of the training set: the last ones of a distance
#: depend on the block it was computed in.
DIGITS = 9


class Reference(NamedTuple):
    """A fitted training set below ``path``."""

    spark: SparkSession
    path: str
    k: int
    bits: int

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}")

    def signals(self, rows: DataFrame) -> DataFrame:
        """(id, hash, SIGNALS) of (id, vec, hash, text), each row against the training set alone."""
        far = outliers.centroid_distance(rows, center=self.table("center"))
        near = similarity.mean_neighbour_distance(rows.select("id", "vec"), self.table("vectors"), self.k)
        d = rows.select("id", "hash", scores.text_length(F.col("text")).alias("text_length")).join(far, "id").join(near, "id", "left")
        return d.fillna(0.0, ["knn_dist"]).select("id", "hash", *[F.col(s).cast("double").alias(s) for s in SIGNALS])


def fit(train: DataFrame, path: str, k: int = 5, bits: int = 64) -> Reference:
    """The reference of (id, vec, hash, text), written below ``path``; one that is there stays."""
    ref = Reference(train.sparkSession, path.rstrip("/"), k, bits)
    if path_exists(ref.spark, f"{ref.path}/scale/_SUCCESS"):
        return ref

    def write(df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").parquet(f"{ref.path}/{name}")

    write(train.where("vec IS NOT NULL").select("id", "vec"), "vectors")
    # two ids of each different hash: a row that is one of them has the other
    some = Window.partitionBy("hash").orderBy("id")
    hashes = train.where("hash IS NOT NULL").select("id", "hash").withColumn("n", F.row_number().over(some)).where("n <= 2")
    write(hashes.select("id", "hash"), "hashes")
    write(outliers.center_of(ref.table("vectors")), "center")
    own = materialize(ref.signals(train), "training-signals")
    write(ranking.cumulative_shares(own.select(*[F.round(s, DIGITS).alias(s) for s in SIGNALS]), list(SIGNALS)), "shares")
    near = hash_neighbours.nearest_hash(own.select("id", "hash"), ref.table("hashes"), bits=bits)
    write(near.agg(F.min(-F.col("dist")).cast("double").alias("__lo"), F.max(-F.col("dist")).cast("double").alias("__hi")), "scale")
    release(own)
    return ref


def _parts(ref: Reference, log: str, before: int | None = None) -> DataFrame | None:
    """The rows of a log, or those of its parts before a number; None without any."""
    if not path_exists(ref.spark, log):
        return None
    kind = ref.table("hashes").schema
    fields = [f"`{f}` {kind[f].dataType.simpleString()}" for f in ("id", "hash")] + [f"{s} double" for s in SIGNALS]
    d = ref.spark.read.schema(", ".join([*fields, "dist int", "part long"])).parquet(log)
    return d if before is None else d.where(F.col("part") < before)


def merged(log_rows: DataFrame) -> DataFrame:
    """(id, hash, SIGNALS, dist) of each id of a log, with the smallest distance found so far."""
    return log_rows.groupBy("id").agg(*[F.min(c).alias(c) for c in ("hash", *SIGNALS, "dist")])


def absorb(ref: Reference, rows: DataFrame, log: str, part: int) -> None:
    """Add (id, vec, hash, text) to the log as its part of that number, which it replaces if it is there."""
    new = materialize(ref.signals(rows), "new-signals")
    known, seen = ref.table("hashes"), _parts(ref, log, part)
    others = known.unionByName(new.select("id", "hash"))
    if seen is not None:
        seen = materialize(merged(seen), "seen-signals")
        others = others.unionByName(seen.select("id", "hash"))
    near = hash_neighbours.nearest_hash(new.select("id", "hash"), others, bits=ref.bits).select("id", "dist")
    out = new.join(near, "id", "left")
    if seen is not None:
        # rows seen before whose nearest hash is a new one; those that have an equal one stay as they are
        may = seen.where("hash IS NOT NULL AND (dist IS NULL OR dist > 0)")
        nearer = hash_neighbours.nearest_hash(may.select("id", "hash"), new.select("id", "hash"), bits=ref.bits)
        nearer = nearer.select("id", F.col("dist").alias("now")).where("now IS NOT NULL")
        may = may.join(nearer, "id").where("dist IS NULL OR now < dist")
        out = out.unionByName(may.withColumn("dist", F.col("now")).drop("now"))
    out.write.mode("overwrite").parquet(f"{log}/part={part}")
    release(new, *([] if seen is None else [seen]))


def _no_scores(ref: Reference) -> DataFrame:
    kind = ref.table("hashes").schema["id"].dataType.simpleString()
    return ref.spark.createDataFrame([], f"id {kind}, dup_score double, ood_score double")


def current_scores(ref: Reference, log: str) -> DataFrame:
    """(id, dup_score, ood_score) of all rows of a log, ranked and scaled among each other."""
    rows = _parts(ref, log)
    if rows is None:
        return _no_scores(ref)
    d = materialize(merged(rows), "log-signals")
    ranked = ranking.average_ranks(d.select("id", *SIGNALS), list(SIGNALS))
    raw = reduce(lambda a, b: a + b, [F.col(f"r_{s}") for s in SIGNALS]) / len(SIGNALS)
    both = d.select("id", (-F.col("dist")).cast("double").alias("dup_raw")).join(ranked.select("id", raw.alias("ood_raw")), "id")
    both = materialize(both, "log-scores")
    return ranking.min_max(ranking.min_max(both, "dup_raw", "dup_score"), "ood_raw", "ood_score").select("id", "dup_score", "ood_score")


def fitted_scores(ref: Reference, log: str) -> DataFrame:
    """(id, dup_score, ood_score) of all rows of a log, ranked and scaled by the training set: the mean
    share of its rows with a smaller or equal signal, and the place of the hash distance between its
    largest and smallest, clipped to 0 .. 1."""
    rows = _parts(ref, log)
    if rows is None:
        return _no_scores(ref)
    steps = ref.table("shares").toPandas().sort_values(["feature", "x"])  # a bounded number of steps a signal
    tables = [(t["x"].to_numpy(), np.r_[0.0, t["share"].to_numpy()]) for t in (steps[steps["feature"] == i] for i in range(len(SIGNALS)))]
    shared = ref.spark.sparkContext.broadcast(tables)

    def mean_share(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            total = np.zeros(len(columns[0]))
            for (x, share), column in zip(shared.value, columns):
                v = column.to_numpy(float)
                total += np.where(np.isnan(v), np.nan, share[np.searchsorted(x, v, "right")])
            yield pd.Series(total / len(SIGNALS))

    share = F.pandas_udf(mean_share, "double")(*[F.round(s, DIGITS) for s in SIGNALS])
    d = merged(rows).join(F.broadcast(ref.table("scale")), how="cross")  # one row
    place = (-F.col("dist") - F.col("__lo")) / F.nullif(F.col("__hi") - F.col("__lo"), F.lit(0.0))
    dup = F.when(F.col("dist").isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(place, F.lit(0.0)))))
    return d.select("id", dup.alias("dup_score"), F.nanvl(share, F.lit(None).cast("double")).alias("ood_score"))
