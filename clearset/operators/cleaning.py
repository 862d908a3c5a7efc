"""From scores to decisions: what to exclude, down-weight, relabel or keep."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearset.operators import ranking

SCORES = ("mislabel_score", "dup_score", "ood_score")


def with_scores(labels: DataFrame, scores: DataFrame) -> DataFrame:
    """Labels with their scores; where a row has none they are 0, and scores_missing says so."""
    d = labels.join(scores.withColumn("__found", F.lit(True)), "id", "left").withColumn("scores_missing", F.col("__found").isNull())
    return d.fillna(0.0, list(SCORES)).drop("__found")


def assemble(ids: DataFrame, mislabel: DataFrame, dup: DataFrame, ood: DataFrame) -> DataFrame:
    """One score table from one table per axis; scores that are missing stay null."""
    return reduce(lambda d, s: d.join(s, "id", "left"), [mislabel, dup, ood], ids.select("id"))


def null_counts(df: DataFrame, cols: tuple[str, ...] = SCORES) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in cols])


def clean_train_set(labels: DataFrame, scores: DataFrame, ood_percentile: float = 95, dup_percentile: float = 95, mislabel_percentile: float = 90, mode: str = "weight", floor: float = 0.1) -> DataFrame:
    """``labels`` with scores, sample_weight and exclude_reason.

    In this order: off-topic rows above their percentile go; of the rows left that lie above
    the duplicate percentile every second one goes, in descending order of the score; rows
    left above the mislabel percentile go (mode ``exclude``) or are weighted down (mode
    ``weight``).  Percentiles are over all rows, missing scores counting 0.
    """
    d = with_scores(labels, scores).drop("scores_missing")
    d = ranking.with_thresholds(d, {"ood_score": ood_percentile / 100, "dup_score": dup_percentile / 100, "mislabel_score": mislabel_percentile / 100})
    ood = F.col("ood_score") > F.col("ood_score_cut")
    candidates = d.where(~ood & (F.col("dup_score") > F.col("dup_score_cut"))).select("id", "dup_score")
    second = ranking.alternate(candidates, "dup_score").where("__second").select("id", F.lit(True).alias("__dup"))
    d = d.join(second, "id", "left")
    reason = F.when(ood, "ood").when(F.col("__dup"), "dup")
    suspect = (F.col("mislabel_score") > F.col("mislabel_score_cut")) & reason.isNull()
    if mode == "exclude":
        reason, weight = F.coalesce(reason, F.when(suspect, "mislabel")), F.lit(1.0)
    else:
        weight = F.when(suspect, 1 - (1 - floor) * F.col("mislabel_score")).otherwise(F.lit(1.0))
    return d.select("id", "label", *SCORES, weight.alias("sample_weight"), reason.alias("exclude_reason"))


def static_cleaning(scores: DataFrame, ood: float = 0.5, mislabel: float = 0.6, dup: float = 0.95) -> DataFrame:
    """(id, outcome): ``ood`` at or above its bound, then ``relabel`` at or above the mislabel
    bound, then ``dup``, else ``keep``."""
    outcome = F.when(~(F.col("ood_score") < ood), "ood").when(F.col("mislabel_score") >= mislabel, "relabel").when(~(F.col("dup_score") < dup), "dup").otherwise("keep")
    return scores.select("id", outcome.alias("outcome"))


def quantile_cleaning(scores: DataFrame, share: float = 0.9) -> DataFrame:
    """(id, outlier): above the quantile of the mislabel or the off-topic score."""
    d = ranking.with_thresholds(scores, {"mislabel_score": share, "ood_score": share})
    return d.select("id", ((F.col("mislabel_score") > F.col("mislabel_score_cut")) | (F.col("ood_score") > F.col("ood_score_cut"))).alias("outlier"))


def hard_mask(scores: DataFrame, percentile: float = 95, person: float = 0.1) -> DataFrame:
    """(id, excluded): above the percentile of the duplicate or off-topic score, or a person
    ratio above ``person``; each signal has a threshold of its own."""
    d = ranking.with_thresholds(scores, {"dup_score": percentile / 100, "ood_score": percentile / 100})
    ratio = F.coalesce(F.col("person_ratio"), F.lit(0.0)) if "person_ratio" in scores.columns else F.lit(0.0)
    return d.select("id", ((F.col("dup_score") > F.col("dup_score_cut")) | (F.col("ood_score") > F.col("ood_score_cut")) | (ratio > person)).alias("excluded"))


def remove_by_scores(labels: DataFrame, suspicions: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """Labels without the ids that any noise type suspects at its threshold or more.
    ``suspicions`` (id, suspicion_score, noise_type); a type without a threshold removes none."""
    return labels.join(flagged(suspicions, thresholds).select("id").distinct(), "id", "left_anti")


def flagged(suspicions: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    hit = reduce(lambda a, b: a | b, [(F.col("noise_type") == k) & (F.col("suspicion_score") >= v) for k, v in thresholds.items()], F.lit(False))
    return suspicions.where(hit)


def removal_report(labels: DataFrame, removed: DataFrame) -> DataFrame:
    """(item, n): rows removed by noise type, distinct ids, rows before and after."""
    by_type = removed.groupBy(F.col("noise_type").alias("item")).agg(F.count("*").alias("n"))
    ids = removed.select("id").distinct()
    rest = [
        ids.agg(F.lit("distinct_removed").alias("item"), F.count("*").alias("n")),
        labels.agg(F.lit("before").alias("item"), F.count("*").alias("n")),
        labels.join(ids, "id", "left_anti").agg(F.lit("after").alias("item"), F.count("*").alias("n")),
    ]
    return reduce(DataFrame.unionByName, rest, by_type)


def suspected_mislabels(labels: DataFrame, oof: DataFrame, least: float = 0.7) -> DataFrame:
    """(id, suspicion_score) where |label - probability| exceeds ``least``; only rows that have a
    probability."""
    d = labels.join(oof, "id").withColumn("suspicion_score", F.abs(F.col("label") - F.col("p")))
    return d.where(F.col("suspicion_score") > least).select("id", "suspicion_score")


def training_pool(cleaned: DataFrame) -> DataFrame:
    """Rows that are not excluded, weighted 1 where no weight is given."""
    weight = F.coalesce(F.col("sample_weight"), F.lit(1.0)) if "sample_weight" in cleaned.columns else F.lit(1.0)
    return cleaned.where(F.col("exclude_reason").isNull()).withColumn("sample_weight", weight)


def export_routes(cleaned: DataFrame, names: tuple[str, str] = ("clean", "dusty")) -> DataFrame:
    """(id, split, bucket): used rows by label, excluded ones by reason; an unknown reason is
    filed as mislabel."""
    used = F.col("exclude_reason").isNull()
    reason = F.when(F.col("exclude_reason").isin("ood", "dup", "mislabel"), F.col("exclude_reason")).otherwise("mislabel")
    bucket = F.when(used, F.when(F.col("label") == 0, names[0]).otherwise(names[1])).otherwise(reason)
    return cleaned.select("id", F.when(used, "train").otherwise("excluded").alias("split"), bucket.alias("bucket"))


def export_counts(routes: DataFrame, listing: DataFrame) -> DataFrame:
    """(split, bucket, copied, missing) against the ids that have a file."""
    d = routes.join(listing.select("id").distinct().withColumn("__file", F.lit(True)), "id", "left")
    return d.groupBy("split", "bucket").agg(F.count("__file").alias("copied"), F.count_if(F.col("__file").isNull()).alias("missing"))


def keep_labels(labels: DataFrame, clean: DataFrame) -> DataFrame:
    """The labels whose id is in the clean set; ids that it repeats count once."""
    return labels.join(clean.select("id"), "id", "left_semi")


def suspicion_list(suspicions: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """The flagged rows, most suspicious first; ties go to the smaller id."""
    return flagged(suspicions, thresholds).orderBy(F.desc("suspicion_score"), "id", "noise_type")
