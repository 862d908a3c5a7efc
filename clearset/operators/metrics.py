"""Ranking and classification metrics with exact treatment of ties."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearset.operators.ranking import _ranged, average_rank


def average_precision(df: DataFrame, score: str, truth: str) -> DataFrame:
    """One row ``ap``: sum of recall steps times precision over falling distinct scores.
    Null where nothing is positive."""
    by_score = df.groupBy((-F.col(score)).alias("s")).agg(F.sum(F.col(truth).cast("long")).alias("tp"), F.count("*").alias("n"))
    d = _ranged(by_score, ["s"], "n").withColumnRenamed("__before", "seen").drop("__total")
    d = _ranged(d, ["s"], "tp").withColumnRenamed("__before", "hits")
    precision = (F.col("hits") + F.col("tp")) / (F.col("seen") + F.col("n"))
    total = F.sum("tp")
    return d.agg((F.sum(F.col("tp") * precision) / F.when(total > 0, total)).alias("ap"))


def roc_auc(df: DataFrame, score: str, truth: str) -> DataFrame:
    """One row ``auc``, ties counting half; null where a class is missing."""
    d = average_rank(df, score, "__rank")
    pos, n = F.sum(F.col(truth).cast("double")), F.count("*")
    ranks = F.sum(F.when(F.col(truth) == 1, F.col("__rank")))
    return d.agg(((ranks - pos * (pos + 1) / 2) / F.when((pos > 0) & (pos < n), pos * (n - pos))).alias("auc"))


def accuracy_and_loss(df: DataFrame, p: str = "p", label: str = "label", weight: str | None = None) -> DataFrame:
    """One row (accuracy, loss): share of right calls at 0.5, mean of weighted log-losses (the
    sum is divided by the rows, not by the weights)."""
    w = F.col(weight) if weight else F.lit(1.0)
    chosen = F.greatest(F.lit(1e-12), F.when(F.col(label) == 1, F.col(p)).otherwise(1 - F.col(p)))
    return df.agg(F.avg(((F.col(p) > 0.5).cast("int") == F.col(label)).cast("double")).alias("accuracy"), F.avg(-F.log(chosen) * w).alias("loss"))


def fold_mean(predictions: DataFrame) -> DataFrame:
    """(id, p): mean probability over the fold models."""
    return predictions.groupBy("id").agg(F.avg("p").alias("p"))
