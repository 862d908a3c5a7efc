"""Off-topic rows: centroid and neighbour distances, rank mixtures, isolation forest, LOF."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearset.functions import scores
from clearset.operators import ranking, similarity, vector_neighbours
from clearset.storage import materialize


def center_of(df: DataFrame) -> DataFrame:
    """One row: the mean vector ``__c`` of ``vec``."""
    parts = df.select(F.posexplode("vec").alias("i", "x")).groupBy("i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return parts.agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda p: p["x"]).alias("__c"))  # one entry a dimension


def centroid_distance(df: DataFrame, reference: DataFrame | None = None, out: str = "centroid_dist", center: DataFrame | None = None) -> DataFrame:
    """(id, centroid_dist): Euclidean distance of ``vec`` to the mean vector of ``reference``
    (of ``df`` itself, if None), or to a ``center`` that is known already (see ``center_of``)."""
    if center is None:
        center = center_of(reference if reference is not None else df)
    return df.join(F.broadcast(center), how="cross").select("id", scores.euclidean(F.col("vec"), F.col("__c")).alias(out))


def rank_average_score(df: DataFrame, k: int = 5, neighbours: bool = True, reference: DataFrame | None = None, scaled: bool = True, approximate: bool = False) -> DataFrame:
    """(id, ood_score) of (id, vec, text): the mean of the average ranks of centroid distance,
    mean distance to ``k`` neighbours and stripped text length, scaled to 0 .. 1.  A row without
    neighbours has distance 0, one without a vector the score 0.5; ``approximate``: neighbours are those of random projections."""
    d = centroid_distance(df, reference).join(df.select("id", scores.text_length(F.col("text")).alias("text_length")), "id")
    signals = ["centroid_dist", "text_length"]
    if neighbours:
        near = similarity.mean_neighbour_distance(df, reference if reference is not None else df, k, approximate=approximate)
        d = d.join(near, "id", "left").fillna(0.0, ["knn_dist"])
        signals.append("knn_dist")
    d = ranking.average_ranks(materialize(d, "ood-signals"), signals)
    raw = reduce(lambda a, b: a + b, [F.col(f"r_{s}") for s in signals]) / len(signals)
    d = d.select("id", raw.alias("raw"))
    if not scaled:
        return d.withColumnRenamed("raw", "ood_score")
    return ranking.min_max(d, "raw", "ood_score", "epsilon").select("id", F.coalesce("ood_score", F.lit(0.5)).alias("ood_score"))


def handcrafted_score(features: DataFrame, knn: DataFrame | None = None) -> DataFrame:
    """(id, ood_score) of a feature table (grid_regularity, dark_blue_gray, skin_ratio,
    vegetation_ratio, watermark_ratio, ocr_text_length), optionally mixed with the rank of the
    neighbour distances ``knn`` (id, knn_dist); a row without a neighbour has distance 0."""
    names = ["grid_regularity", "dark_blue_gray", "skin_ratio", "vegetation_ratio", "watermark_ratio", "ocr_text_length"]
    d = features.select("id", *names)
    if knn is not None:
        d = d.join(knn, "id", "left").fillna(0.0, ["knn_dist"])
        names = [*names, "knn_dist"]
    d = ranking.ordinal_ranks(d, names)
    panel = 0.5 * F.col("r_grid_regularity") + F.col("r_dark_blue_gray") - F.col("r_skin_ratio") - F.col("r_vegetation_ratio")
    d = ranking.ordinal_rank(d.withColumn("panel", panel), "panel", "r_panel")
    marks = [F.col("r_watermark_ratio"), F.col("r_ocr_text_length")]
    score = F.greatest(1 - F.col("r_panel"), *marks)
    if knn is not None:
        score = F.greatest(0.5 * score + 0.5 * F.col("r_knn_dist"), *marks)
    return d.select("id", score.alias("ood_score"))


def fused_score(df: DataFrame) -> DataFrame:
    """(id, ood_score) of (id, handcrafted, ocr_text_length and, if there, zero_shot and
    person_ratio): 0.7 and 0.3 of the ranks of zero-shot and hand-crafted score, protected by
    the ranks of text length and person ratio; without zero-shot the hand-crafted score."""
    fused = "zero_shot" in df.columns
    ranked = (["zero_shot", "handcrafted", "ocr_text_length"] if fused else []) + (["person_ratio"] if "person_ratio" in df.columns else [])
    d = ranking.ordinal_ranks(df, [*ranked, *([] if fused else ["handcrafted"])]) if ranked else df
    score = F.greatest(0.7 * F.col("r_zero_shot") + 0.3 * F.col("r_handcrafted"), F.col("r_ocr_text_length")) if fused else F.col("handcrafted")
    if "person_ratio" in df.columns:
        score = F.greatest(score, F.col("r_person_ratio"))
    return d.select("id", score.alias("ood_score"))


def local_outlier_factor(df: DataFrame, k: int = 20, approximate: bool = False) -> DataFrame:
    """(id, lof) of (id, vec) from the graph of ``k`` nearest neighbours; ``approximate``: found by
    random projections.  Equal vectors are searched as one (see ``vector_neighbours``)."""
    near = vector_neighbours.nearest(df, df, k, similarity.euclidean, vector_neighbours.projected if approximate else vector_neighbours.exact)
    g = materialize(near.select("id", "nn_id", (-F.col("sim")).alias("d")), "lof-graph")
    kdist = g.groupBy("id").agg(F.max("d").alias("kdist"))
    reach = g.join(kdist.withColumnRenamed("id", "nn_id"), "nn_id").select("id", "nn_id", F.greatest("d", "kdist").alias("reach"))
    density = materialize(reach.groupBy("id").agg((1 / (F.avg("reach") + 1e-10)).alias("lrd")), "lof-density")
    around = g.join(density.select(F.col("id").alias("nn_id"), F.col("lrd").alias("other")), "nn_id").groupBy("id").agg(F.avg("other").alias("mean"))
    return around.join(density, "id").select("id", (F.col("mean") / F.col("lrd")).alias("lof"))


def _average_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among n values."""
    m = np.maximum(n - 1, 1)
    return np.where(n > 2, 2 * (np.log(m) + 0.5772156649015329) - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


def isolation_forest(df: DataFrame, contamination: float = 0.05, trees: int = 100, sample: int = 256, seed: int = 42) -> DataFrame:
    """(id, suspicion_score, flagged) of (id, vec).

    Each tree grows in a task from about ``sample`` rows, chosen by hash; the trees, whose
    size that bounds, are broadcast and score all rows; the threshold is the quantile of the
    scores.
    """
    n = df.count()
    share = min(1.0, sample / max(n, 1))
    scale = 1 << 24
    picks = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.pmod(F.xxhash64(F.lit(seed), t, F.col("id")), F.lit(scale)) < int(share * scale) + (share >= 1))
    rows = df.select("id", "vec", F.explode(picks).alias("tree"))
    limit = int(np.ceil(np.log2(max(sample, 2))))

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        x = np.stack(pdf["vec"].to_numpy()).astype(np.float64)
        tree = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng([seed, tree])
        nodes, todo = [], [(np.arange(len(x)), 0)]
        while todo:  # children are appended behind their parent
            own, depth = todo.pop(0)
            spread = np.flatnonzero(np.ptp(x[own], axis=0) > 0) if len(own) > 1 and depth < limit else []
            if not len(spread):
                nodes.append((-1, 0.0, -1, float(depth + _average_path(np.array([len(own)]))[0])))
                continue
            f = int(rng.choice(spread))
            cut = float(rng.uniform(x[own, f].min(), x[own, f].max()))
            nodes.append((f, cut, len(nodes) + len(todo) + 1, 0.0))
            todo += [(own[x[own, f] <= cut], depth + 1), (own[x[own, f] > cut], depth + 1)]
        f, c, k, p = zip(*nodes)
        return pd.DataFrame({"tree": tree, "node": range(len(nodes)), "feature": f, "cut": c, "child": k, "path": p, "rows": len(x)})

    grown = rows.groupBy("tree").applyInPandas(grow, "tree int, node int, feature int, cut double, child int, path double, rows int").toPandas()
    forest = [g.sort_values("node") for _, g in grown.groupby("tree")]
    shared = df.sparkSession.sparkContext.broadcast([tuple(g[c].to_numpy() for c in ("feature", "cut", "child", "path")) for g in forest])
    usual = float(_average_path(np.array([max(2.0, float(np.mean([g["rows"].iloc[0] for g in forest])) if forest else 2.0)]))[0])

    def depth(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in batches:
            x = np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 1))
            total = np.zeros(len(x))
            for feature, cut, child, path in shared.value:
                at = np.zeros(len(x), int)
                while (live := np.flatnonzero(feature[at] >= 0)).size:
                    node = at[live]
                    at[live] = child[node] + (x[live, feature[node]] > cut[node])
                total += path[at]
            yield pd.Series(2.0 ** (-total / max(len(shared.value), 1) / usual))

    scored = materialize(df.select("id", F.pandas_udf(depth, "double")("vec").alias("suspicion_score")), "isolation")
    d = ranking.with_thresholds(scored, {"suspicion_score": 1 - contamination})
    return d.select("id", "suspicion_score", (F.col("suspicion_score") > F.col("suspicion_score_cut")).alias("flagged"))


def augmented_vectors(df: DataFrame, features: list[str], weight: float = 3.0) -> DataFrame:
    """(id, vec) with the z-scores (population deviation + 1e-8) of ``features`` times ``weight``
    appended to each vector."""
    stats = df.agg(*[a for f in features for a in (F.avg(f).alias(f"__m_{f}"), F.stddev_pop(f).alias(f"__s_{f}"))])
    d = df.join(F.broadcast(stats), how="cross")
    extra = F.array(*[weight * (F.col(f) - F.col(f"__m_{f}")) / (F.col(f"__s_{f}") + 1e-8) for f in features])
    return d.select("id", F.concat(F.col("vec").cast("array<double>"), extra).alias("vec"))


def mask_coverage(detections: DataFrame, ids: DataFrame, label: int = 1, least: float = 0.7) -> DataFrame:
    """(id, person_ratio): share of pixels under any mask (one byte a pixel) of the label with the
    score; 0 without one."""
    own = detections.where((F.col("det_label") == label) & (F.col("det_score") >= least))

    def cover(pdf: pd.DataFrame) -> pd.DataFrame:
        masks = [np.frombuffer(m, np.uint8) > 0 for m in pdf["mask"]]
        return pd.DataFrame({"id": [pdf["id"].iloc[0]], "ratio": [float(np.logical_or.reduce(masks).sum() / (pdf["height"].iloc[0] * pdf["width"].iloc[0]))]})

    kind = detections.schema["id"].dataType.simpleString()
    found = own.groupBy("id").applyInPandas(cover, f"id {kind}, ratio double")
    return ids.select("id").join(found, "id", "left").select("id", F.coalesce("ratio", F.lit(0.0)).alias("person_ratio"))
