"""Summaries of score tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearset.operators import ranking

QUANTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75, "q95": 0.95, "q99": 0.99}


def _with_quantiles(stats: DataFrame, long: DataFrame, shares: dict[str, float], group: str) -> DataFrame:
    """``stats`` (group, n and more) with the quantiles of the values ``long`` (group, x)."""
    found = ranking.group_quantiles(long, shares, group).withColumnRenamed(group, "__group")
    return stats.join(found, F.col(group).eqNullSafe(F.col("__group")), "left").drop("__group")


def _by_axis(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("axis"), F.col(c).cast("double").alias("x")) for c in cols])).alias("s")).select("s.*")


def summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """(axis, n, min, max, mean, std, quantiles) of each column."""
    long, c = _by_axis(df, cols), F.col("x")
    stats = long.groupBy("axis").agg(F.count(c).alias("n"), F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"))
    return _with_quantiles(stats, long, QUANTILES, "axis")


def describe_by(df: DataFrame, group: str, col: str) -> DataFrame:
    """count, mean, std, min, quartiles and max of ``col`` for each group."""
    c = F.col(col)
    stats = df.groupBy(group).agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"))
    out = _with_quantiles(stats, df.select(group, F.col(col).alias("x")), {"q25": 0.25, "q50": 0.5, "q75": 0.75}, group)
    return out.select(group, "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def flatness(df: DataFrame, cols: list[str], least_std: float = 1e-3, tie_share: float = 0.1) -> DataFrame:
    """(axis, flat, max_count, tied): a column without spread, or whose largest value takes
    more than a tenth of the rows."""
    long = _by_axis(df, cols)
    counts = long.groupBy("axis", "x").agg(F.count("*").alias("n"))
    top = counts.groupBy("axis").agg(F.max(F.struct("x", "n")).alias("top"))
    spread = long.groupBy("axis").agg(F.stddev_samp("x").alias("std"), F.count("*").alias("rows"))
    return spread.join(top, "axis").select("axis", (F.col("std") < least_std).alias("flat"), F.col("top.n").alias("max_count"), (F.col("top.n") > tie_share * F.col("rows")).alias("tied"))


def histogram(df: DataFrame, col: str, bins: int, group: str | None = None) -> DataFrame:
    """([group,] bin, lo, n): equal widths from the smallest to the largest value, of each
    group its own; the last bin is closed, empty bins are there."""
    keys = [group] if group else []
    own = df.where(F.col(col).isNotNull())
    ends = own.groupBy(*keys).agg(F.min(col).alias("__lo"), F.max(col).alias("__hi"))
    width = (F.col("__hi") - F.col("__lo")) / bins
    d = own.join(F.broadcast(ends), keys) if keys else own.join(F.broadcast(ends), how="cross")
    at = F.when(F.col("__hi") == F.col("__lo"), F.lit(0)).otherwise(F.least(F.floor((F.col(col) - F.col("__lo")) / F.when(width != 0, width)), F.lit(bins - 1)))
    counts = d.groupBy(*keys, at.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    frame = ends.select(*keys, "__lo", width.alias("__w"), F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return frame.join(counts, [*keys, "bin"], "left").select(*keys, "bin", (F.col("__lo") + F.col("bin") * F.col("__w")).alias("lo"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def value_counts(df: DataFrame, *cols: str) -> DataFrame:
    return df.groupBy(*cols).agg(F.count("*").alias("n"))


def pearson(df: DataFrame, cols: list[str]) -> DataFrame:
    """(a, b, r) of all pairs of columns, in one pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    return row.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}|{b}`").alias("r")) for a, b in pairs])).alias("p")).select("p.*")


def spearman(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """(feature, rho): Pearson correlation of average ranks with those of ``target``."""
    cols = [*features, target]
    d = ranking.with_average_ranks(df.select(*cols), {c: f"__r_{c}" for c in cols})
    row = d.agg(*[F.corr(f"__r_{f}", f"__r_{target}").alias(f) for f in features])
    return row.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("rho")) for f in features])).alias("p")).select("p.*")


def confidence(df: DataFrame, p: str = "oof_pred_prob", label: str = "label") -> DataFrame:
    """Shares of undecided (0.3 .. 0.7) and over-confident (beyond 0.1 and 0.9) probabilities,
    and how many of the latter are wrong."""
    x = F.col(p)
    wrong = ((x > 0.9) & (F.col(label) == 0)) | ((x < 0.1) & (F.col(label) == 1))
    return df.agg(F.avg(((x > 0.3) & (x < 0.7)).cast("double")).alias("undecided"), F.avg(((x > 0.9) | (x < 0.1)).cast("double")).alias("overconfident"), F.count_if(wrong).alias("wrong"), F.avg(wrong.cast("double")).alias("wrong_share"))


def top_versus_all(df: DataFrame, score: str, features: list[str], n: int = 20) -> DataFrame:
    """(feature, top_mean, mean, diff_percent): the ``n`` highest scorers against all rows."""
    long = lambda d, name: d.agg(*[F.avg(f).alias(f) for f in features]).select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias(name)) for f in features])).alias("s")).select("s.*")
    top, rest = long(ranking.top_n(df, score, n), "top_mean"), long(df, "mean")
    return top.join(F.broadcast(rest), "feature").withColumn("diff_percent", (F.col("top_mean") - F.col("mean")) / (F.abs("mean") + 1e-8) * 100)


def positive_subset(df: DataFrame, measure: str, score: str) -> DataFrame:
    """One row: rows with a positive measure, their share, their mean score and that of all."""
    hit = F.col(measure) > 0
    return df.agg(F.count_if(hit).alias("n"), F.avg(hit.cast("double")).alias("share"), F.avg(F.when(hit, F.col(score))).alias("mean_score"), F.avg(score).alias("mean_all"))


def index_range(df: DataFrame, index: str, score: str, share: float = 0.95) -> DataFrame:
    """One row: smallest and largest index and number of rows at the quantile or above."""
    d = ranking.with_thresholds(df, {score: share})
    return d.where(F.col(score) >= F.col(f"{score}_cut")).agg(F.min(index).alias("min_index"), F.max(index).alias("max_index"), F.count("*").alias("n"))


def label_counts_of_top(df: DataFrame, score: str, n: int = 20) -> DataFrame:
    return value_counts(ranking.top_n(df, score, n), "label")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
