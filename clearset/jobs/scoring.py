"""Whole jobs: three-axis scores, module pipelines, cross-set scores, batch predictions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearset.functions import scores
from clearset.operators import cleaning, dedup, hash_neighbours, images, mislabel, outliers, ranking, similarity
from clearset.storage import materialize


#: Image features that make the hand-crafted off-topic score.
HANDCRAFTED = ("grid_regularity", "dark_blue_gray", "skin_ratio", "vegetation_ratio", "watermark_ratio", "ocr_text_length")


def off_topic(features: DataFrame, vectors: DataFrame, k: int = 5) -> DataFrame:
    """(id, ood_score, ood_score_handcrafted) of (id, the HANDCRAFTED features and, if there,
    zero_shot and person_ratio) and (id, vec)."""
    near = similarity.mean_neighbour_distance(vectors, vectors, k)
    hand = materialize(outliers.handcrafted_score(features, near).withColumnRenamed("ood_score", "handcrafted"), "handcrafted")
    more = [c for c in ("zero_shot", "person_ratio") if c in features.columns]
    fused = outliers.fused_score(features.select("id", "ocr_text_length", *more).join(hand, "id"))
    return fused.join(hand.withColumnRenamed("handcrafted", "ood_score_handcrafted"), "id")


def image_rows(labels: DataFrame, files: DataFrame, embed: Callable[[pd.DataFrame], np.ndarray] = images.color_grid, hash_side: int = 8) -> DataFrame:
    """(id, label, decoded, vec, hash and the image features) of every labelled id, whether its file of
    ``files`` (see ``sources.tables.read_images`` with keep_invalid) can be read or not.

    What cannot be read has a default for each signal: no vector, a null hash, features 0; decoded is
    false for a file that cannot be decoded and for an id without a file.
    """
    good = files.where("decoded")
    found = images.image_features(good, hash_side).join(images.embed(good, embed), "id")
    d = labels.select("id", "label").join(found.withColumn("decoded", F.lit(True)), "id", "left")
    d = d.fillna(0.0, [c for c in images.FEATURES if c != "hash"]).fillna(False, ["decoded"])
    return materialize(d, "image-rows")


class ScoreTables(NamedTuple):
    scores: DataFrame
    diagnostics: DataFrame
    features: DataFrame | None


def score_all(rows: DataFrame, k: int = 5, features: DataFrame | None = None) -> ScoreTables:
    """Score, diagnostic and feature tables of (id, label, vec, hash, text).

    Duplicate score and off-topic score first; rows beyond their percentiles train no label
    model, the others are weighted by how typical they are; rows that share a near duplicate
    with another label are suspected at least a little.  With ``features`` (see ``off_topic``)
    the off-topic score is the fused one, a person_ratio above its threshold excludes a row
    as well, and the third table holds the features; without, the mean of ranks takes its place.
    A row without a vector stays: its duplicate score is 0, its off-topic score that of its features
    (0.5 without any), its mislabel score 0.5, and no probability is given.
    """
    dup = materialize(similarity.dup_scores(rows.select("id", "hash", "vec")), "dup-scores")
    if features is None:
        ood = outliers.rank_average_score(rows, k)
    else:
        ood = off_topic(features, rows.select("id", "vec"), k)
    ood = materialize(ood, "ood-scores")
    d = rows.select("id", "label", "vec").join(dup, "id").join(ood.select("id", "ood_score"), "id")
    signals = ["dup_score", "ood_score"]
    if features is not None and "person_ratio" in features.columns:
        d = d.join(features.select("id", "person_ratio"), "id")
        signals.append("person_ratio")
    excluded = cleaning.hard_mask(d.select("id", *signals))
    d = materialize(d.join(excluded, "id").withColumn("weight", scores.soft_weight(F.col("ood_score"))), "score-input")
    found = mislabel.mislabel_scores(d.where("vec IS NOT NULL"), excluded="excluded", weight="weight")
    cut = ranking.quantiles(d, {"dup_score": 0.95}).first()[0]
    conflict = similarity.label_conflicts(dup, d.select("id", "label"), cut).withColumn("conflict", F.lit(True))
    out = d.select("id", "label", "dup_score", "ood_score").join(found, "id", "left").fillna(0.5, ["mislabel_score"]).join(conflict, "id", "left")
    out = out.withColumn("mislabel_score", scores.boosted(F.col("mislabel_score"), F.coalesce("conflict", F.lit(False))))
    out = materialize(out, "scores")
    table = None
    if features is not None:
        raw = F.col("zero_shot") if "zero_shot" in features.columns else F.lit(None).cast("double")
        values = features.select("id", raw.alias("zero_shot"), *HANDCRAFTED)
        table = rows.select("id", "label").join(ood, "id").join(values, "id")
    return ScoreTables(out.select("id", *cleaning.SCORES), out.select("id", "label", "oof_pred_prob", *cleaning.SCORES), table)


def write_tables(tables: ScoreTables, path: str, mode: str = "error") -> None:
    """Write each table of ``score_all`` as Parquet below ``path``: scores, diagnostics, features."""
    for name, table in tables._asdict().items():
        if table is not None:
            table.write.mode(mode).parquet(f"{path}/{name}")


def filter_pipeline(rows: DataFrame, modules: tuple[str, ...] = ("duplicate", "ood", "mislabel"), max_distance: int = 4, contamination: float = 0.03, oof: DataFrame | None = None, bits: int = 64) -> tuple[DataFrame, DataFrame]:
    """(cleaned (id, label), report) of (id, label, vec, hash) after the given modules;
    ``bits``: of a hash."""
    kind = rows.schema["id"].dataType.simpleString()
    parts = []
    if "duplicate" in modules:
        parts.append(dedup.greedy_dedup(rows, max_distance, bits=bits).select("id", "suspicion_score", F.lit("duplicate").alias("noise_type")))
    if "ood" in modules:
        found = outliers.isolation_forest(rows, contamination)
        parts.append(found.where("flagged").select("id", "suspicion_score", F.lit("ood").alias("noise_type")))
    if "mislabel" in modules and oof is not None:
        parts.append(cleaning.suspected_mislabels(rows.select("id", "label"), oof).withColumn("noise_type", F.lit("mislabel")))
    none = rows.sparkSession.createDataFrame([], f"id {kind}, suspicion_score double, noise_type string")
    removed = materialize(reduce(DataFrame.unionByName, parts, none), "removed")
    labels = rows.select("id", "label")
    return labels.join(removed.select("id").distinct(), "id", "left_anti"), cleaning.removal_report(labels, removed)


def cross_set_scores(train: DataFrame, test: DataFrame, k: int = 5, bits: int = 64) -> DataFrame:
    """(id, dup_score, ood_score) of test rows (id, vec, hash, text) against the training set:
    nearest hash among both sets, ranks of distances to the training set.  ``bits``: of a hash."""
    both = train.select("id", "hash").unionByName(test.select("id", "hash"))
    near = hash_neighbours.nearest_hash(test.select("id", "hash"), both, bits=bits)
    d = near.withColumn("dup_raw", -F.col("dist").cast("double"))
    ood = outliers.rank_average_score(test, k, reference=train, scaled=False).withColumnRenamed("ood_score", "ood_raw")
    d = materialize(d.join(ood, "id").select("id", "dup_raw", "ood_raw"), "cross-set")
    return ranking.min_max(ranking.min_max(d, "dup_raw", "dup_score"), "ood_raw", "ood_score").select("id", "dup_score", "ood_score")


def predict(rows: DataFrame, models: dict[str, Callable[[pd.DataFrame], np.ndarray]], id_col: str = "id") -> DataFrame:
    """(id, model, p): every model scores every batch of rows inside the tasks."""
    kind = rows.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, fn in models.items():
                yield pd.DataFrame({"id": pdf[id_col], "model": name, "p": np.asarray(fn(pdf), float)})

    return rows.mapInPandas(run, f"id {kind}, model string, p double")
