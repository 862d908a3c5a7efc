"""Suspected label errors from out-of-fold logistic regression.

All fold models are fitted together: an iteration is one pass over the rows, in which every task
adds its part of the gradient and Hessian of each model (a row takes part in the models of the other
folds), and one Newton step of each on the driver.  So the number of jobs does not grow with the
folds, and what a task sends is (dimensions + 1) squared over two numbers a model.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearset.functions import scores
from clearset.operators import ranking
from clearset.storage import materialize, release

#: Steps of the fit, and the largest change of a coefficient at which it has come to rest.
STEPS, REST = 60, 1e-9
#: Partial sums of a model that one task adds up, before one adds these.
FAN_IN = 64


class Model(NamedTuple):
    """Logistic regression on standardised vectors; ``beta`` ends with the intercept."""

    mean: np.ndarray
    dev: np.ndarray
    beta: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.dev @ self.beta[:-1] + self.beta[-1]
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def _statistics(rows: DataFrame) -> tuple[dict, dict]:
    """({fold: (n, mean, squares)}, {(fold, label): n}): a row a fold and dimension is collected."""
    parts = rows.select("fold", F.posexplode("vec").alias("i", "x")).groupBy("fold", "i")
    moments: dict[int, list] = {}
    for r in parts.agg(F.count("*").alias("n"), F.avg("x").alias("m"), F.var_pop("x").alias("v")).orderBy("fold", "i").collect():
        moments.setdefault(r["fold"], []).append((r["n"], r["m"], r["n"] * r["v"]))
    sizes = {(r["fold"], r["label"]): r["n"] for r in rows.groupBy("fold", "label").agg(F.count("*").alias("n")).collect()}
    return {f: tuple(np.array(x, float) for x in zip(*m)) for f, m in moments.items()}, sizes


def _standard(moments: dict, left_out: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and population deviation (1 where a column is constant) of the other folds' rows."""
    n, m, s = (np.stack(x) for x in zip(*[v for f, v in moments.items() if f != left_out]))
    mean = (n * m).sum(0) / n.sum(0)
    dev = np.sqrt((s + n * (m - mean) ** 2).sum(0) / n.sum(0))
    return mean, np.where(dev > 0, dev, 1.0)


def _sums(rows: DataFrame, models: list[Model], folds: list[int], balance: list[dict[int, float]]) -> list[np.ndarray]:
    """Loss, gradient and upper Hessian of each model in one array, without the penalty."""
    shared = rows.sparkSession.sparkContext.broadcast((models, folds, balance))

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for pdf in filter(len, batches):
            x, y, fold = np.stack(pdf["vec"]).astype(float), pdf["label"].to_numpy(float), pdf["fold"].to_numpy()
            for k, (m, f, b) in enumerate(zip(*shared.value)):
                own = fold != f
                z = np.c_[(x[own] - m.mean) / m.dev, np.ones(own.sum())]
                w = pdf["weight"].to_numpy(float)[own] * np.where(y[own] == 1, b.get(1, 0.0), b.get(0, 0.0))
                s = z @ m.beta
                p = 1 / (1 + np.exp(-np.clip(s, -700, 700)))
                loss = (w * (np.logaddexp(0, s) - y[own] * s)).sum()
                hessian = (z * (w * p * (1 - p))[:, None]).T @ z
                sums = np.r_[loss, z.T @ (w * (p - y[own])), hessian[np.triu_indices(len(m.beta))]]
                total[k] = total.get(k, 0) + sums
        if total:  # a task without rows adds nothing
            yield pd.DataFrame({"model": list(total), "part": TaskContext.get().partitionId() // FAN_IN, "sums": list(total.values())})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"model": pdf["model"].iloc[:1], "part": 0, "sums": [np.sum(np.stack(pdf["sums"]), axis=0)]})

    schema = "model int, part int, sums array<double>"
    parts = rows.select("vec", "label", "weight", "fold").mapInPandas(part, schema).groupBy("model", "part").applyInPandas(add, schema)
    found = {r["model"]: np.array(r["sums"]) for r in parts.groupBy("model").applyInPandas(add, schema).collect()}  # one row a model
    return [found[k] for k in range(len(models))]


def fit(rows: DataFrame, folds: list[int], c: float) -> list[Model]:
    """A model for each of ``folds``, trained on the rows (vec, label, weight, fold) of all other folds:
    balanced classes, and the penalty of a summed loss with inverse strength ``c``.  Where these
    have one label only, the model gives it to every row."""
    moments, sizes = _statistics(rows)
    dims = len(next(iter(moments.values()))[1]) if moments else 0
    models, balance, live = [], [], []
    for f in folds:
        counts: dict[int, int] = {}
        for (fold, label), n in sizes.items():
            if fold != f:
                counts[label] = counts.get(label, 0) + n
        beta = np.zeros(dims + 1)
        if len(counts) == 1:
            beta[-1] = 700.0 if 1 in counts else -700.0
        mean, dev = _standard(moments, f) if counts else (np.zeros(dims), np.ones(dims))
        models.append(Model(mean, dev, beta))
        balance.append({label: sum(counts.values()) / (len(counts) * n) for label, n in counts.items()})
        live.append(len(counts) > 1)
    ridge = np.r_[np.full(dims, 1 / c), 0.0]
    upper = np.triu_indices(dims + 1)
    steps, losses, stepped = [np.zeros(dims + 1) for _ in folds], [np.inf] * len(folds), [m.beta for m in models]
    for _ in range(STEPS):
        open_ = [k for k in range(len(folds)) if live[k]]
        if not open_:
            break
        sums = _sums(rows, [models[k] for k in open_], [folds[k] for k in open_], [balance[k] for k in open_])
        for k, s in zip(open_, sums):
            beta = models[k].beta
            loss = s[0] + (ridge * beta**2).sum() / 2
            if loss > losses[k] + 1e-9 * abs(losses[k]):  # too far: half the step from where it began
                steps[k] = steps[k] / 2
            else:
                hessian = np.zeros((dims + 1, dims + 1))
                hessian[upper] = s[dims + 2 :]
                hessian = hessian + np.triu(hessian, 1).T + np.diag(ridge)
                steps[k] = -np.linalg.lstsq(hessian, s[1 : dims + 2] + ridge * beta, rcond=None)[0]
                losses[k], stepped[k] = loss, beta
            models[k] = models[k]._replace(beta=stepped[k] + steps[k])
            live[k] = np.abs(steps[k]).max() > REST
    return models


def _predict(rows: DataFrame, models: list[Model]) -> DataFrame:
    """(id, p) of rows (id, vec, fold): the model of the row's fold, or the mean of all where that is null."""
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                x, fold = np.stack(pdf["vec"]).astype(float), pdf["fold"].to_numpy(float)
                every = np.stack([m.probability(x) for m in shared.value], axis=1)
                own = every[np.arange(len(x)), np.where(np.isnan(fold), 0, fold).astype(int)]
                yield pd.DataFrame({"id": pdf["id"], "p": np.where(np.isnan(fold), every.mean(1), own)})

    kind = rows.schema["id"].dataType.simpleString()
    return rows.select("id", "vec", "fold").mapInPandas(run, f"id {kind}, p double")


def out_of_fold(df: DataFrame, k: int = 5, c: float = 0.1, excluded: str | None = None, weight: str | None = None, seed: int = 42) -> DataFrame:
    """(id, p) of (id, vec, label): probability of label 1 from the model of the other folds;
    excluded rows train nothing and get the mean over all fold models."""
    d = df.select("id", "vec", F.col("label").cast("int").alias("label"), (F.col(excluded) if excluded else F.lit(False)).alias("out"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight"))
    d = materialize(d, "fold-rows")
    folds = ranking.effective_folds(d.where(~F.col("out")), k)
    used = materialize(ranking.stratified_folds(d.where(~F.col("out")), folds, seed=seed), "folds")
    models = fit(used, list(range(folds)), c)
    rest = d.where("out").select("id", "vec", F.lit(None).cast("int").alias("fold"))
    out = materialize(_predict(used.select("id", "vec", "fold").unionByName(rest), models), "out-of-fold")
    release(d, used)
    return out


def mislabel_scores(df: DataFrame, k: int = 5, iterations: int = 2, c: float = 0.1, excluded: str | None = None, weight: str | None = None, percentile: float = 95) -> DataFrame:
    """(id, oof_pred_prob, mislabel_score).  After each pass but the last, rows above the
    percentile of the score train the next pass no more."""
    d = df.withColumn("__out", F.col(excluded) if excluded else F.lit(False))
    for i in range(iterations):
        p = out_of_fold(d, k, c, "__out", weight)
        scored = materialize(d.join(p, "id").withColumn("mislabel_score", scores.mislabel_gap(F.col("p"), F.col("label"))), "mislabel")
        if i + 1 < iterations:
            cut = ranking.with_thresholds(scored, {"mislabel_score": percentile / 100})
            start = F.col(excluded) if excluded else F.lit(False)
            d = cut.withColumn("__out", start | (F.col("mislabel_score") > F.col("mislabel_score_cut"))).drop("p", "mislabel_score", "mislabel_score_cut")
    return scored.select("id", F.col("p").alias("oof_pred_prob"), "mislabel_score")


def in_sample(df: DataFrame, c: float = 1.0) -> DataFrame:
    """(id, mislabel_score): a baseline that scores the rows it was fitted on by the probability
    of the other label."""
    d = df.select("id", "vec", F.col("label").cast("int").alias("label"), F.lit(1.0).alias("weight"), F.lit(-1).alias("fold"))
    d = materialize(d, "in-sample-rows")
    model = fit(d, [0], c)
    p = _predict(d.withColumn("fold", F.lit(0)), model)
    return d.join(p, "id").select("id", scores.mislabel_gap(F.col("p"), F.col("label")).alias("mislabel_score"))
