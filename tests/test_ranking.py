"""Quantiles by narrowing ranges and ranks of many columns at once, against numpy and pandas."""

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clearset.operators import diagnostics, outliers, ranking

SHARES = {"least": 0.0, "low": 0.05, "third": 1 / 3, "half": 0.5, "high": 0.99, "most": 1.0}


def values(kind, n):
    rng = np.random.default_rng(n)
    return {
        "normal": rng.normal(size=n),
        "mostly zero": np.where(rng.random(n) < 0.9, 0.0, rng.normal(size=n)),
        "huge range": rng.choice([-1e308, -1.0, 0.0, 1e-300, 1e308], n),
        "whole numbers": rng.integers(0, 7, n).astype(float),
        "near each other": 1.0 + rng.integers(0, 5000, n) * 2.0**-52,
        "one value": np.full(n, 2.5),
    }[kind]


@pytest.mark.parametrize("kind", ["normal", "mostly zero", "huge range", "whole numbers", "near each other", "one value"])
def test_narrowed_quantiles_equal_numpy(spark, monkeypatch, kind):
    monkeypatch.setattr(ranking, "BINS", 8)
    monkeypatch.setattr(ranking, "LAST", 5)
    rows = [(g, float(x)) for g, n in (("a", 700), ("b", 11), (None, 1)) for x in values(kind, n)] + [("a", None), ("a", math.nan), ("empty", None)]
    df = spark.createDataFrame(rows, "axis string, x double").repartition(5)
    got = {r["axis"]: r for r in ranking.group_quantiles(df, SHARES, direct=0).collect()}
    assert set(got) == {"a", "b", None}
    for g in got:
        own = np.array([x for h, x in rows if h == g and x is not None and not math.isnan(x)])
        for name, p in SHARES.items():
            place = (len(own) - 1) * p
            low, high = np.sort(own)[[math.floor(place), math.ceil(place)]]
            assert got[g][name] == pytest.approx(low + (high - low) * (place - math.floor(place)), rel=1e-12), (g, name)


def test_narrowing_and_the_aggregate_agree(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(rng.gauss(0, 1), float(rng.randrange(4))) for _ in range(3000)] + [(None, 1.0)], "u double, v double")
    cols = {"u": 0.95, "v": 0.5}
    a, b = ranking.quantiles(df, cols, direct=0).first(), ranking.quantiles(df, cols).first()
    assert a["u"] == pytest.approx(b["u"], abs=1e-12) and a["v"] == b["v"]
    assert ranking.quantiles(df.where("v > 9"), cols).first()["u"] is None
    infinite = spark.createDataFrame([(float(x),) for x in ["-inf", "inf", 1, 2, 3]], "u double")
    assert ranking.quantiles(infinite, {"u": 0.5}, direct=0).first()["u"] == 2.0


def test_no_task_holds_more_than_the_bins(spark, monkeypatch):
    monkeypatch.setattr(ranking, "LAST", 100)
    df = spark.range(200_000).select(F.lit("a").alias("axis"), (F.col("id") * 0.5).alias("x"))
    r = ranking.group_quantiles(df, {"q": 0.75}).first()
    assert r["q"] == pytest.approx(0.75 * 199_999 * 0.5)


def test_summary_and_describe_with_groups_of_nulls(spark, monkeypatch):
    monkeypatch.setattr(ranking, "DIRECT", 0)
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("x", 5.0), ("y", None)], "g string, n double")
    got = {r["g"]: (r["count"], r["q50"], r["max"]) for r in diagnostics.describe_by(df, "g", "n").collect()}
    assert got == {None: (2, 2.0, 3.0), "x": (1, 5.0, 5.0), "y": (0, None, None)}
    s = diagnostics.summary(df, ["n"]).first()
    assert (s["n"], s["q50"]) == (3, 3.0)


def test_ranks_of_many_columns_equal_single_ones(spark):
    rng = random.Random(4)
    rows = [(i, rng.choice([0.0, 0.0, 1.0, rng.random()]), rng.randrange(5), None if i % 7 == 0 else rng.random()) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, a double, b int, c double").repartition(6)
    pdf = pd.DataFrame(rows, columns=["id", "a", "b", "c"])
    ordinal = ranking.ordinal_ranks(df, ["a", "b", "c"]).toPandas().sort_values("id")
    average = ranking.average_ranks(df, ["a", "b", "c"]).toPandas().sort_values("id")
    for c in "abc":
        order = pdf.sort_values([c, "id"], na_position="last")["id"].tolist()
        place = {i: k for k, i in enumerate(order)}
        assert np.allclose(ordinal[f"r_{c}"], [place[i] / (399 + 1e-8) for i in ordinal["id"]])
        assert np.allclose(average[f"r_{c}"], pdf[c].rank(), equal_nan=True) and np.allclose(average[c], pdf[c], equal_nan=True)
    down = ranking.with_average_ranks(df, {"b": "rb"}, descending=True).toPandas().sort_values("id")
    assert np.allclose(down["rb"], pdf["b"].rank(ascending=False)) and down["c"].isna().sum() == 58


def test_a_row_without_neighbours_stays(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0], "text")], "id long, vec array<double>, text string")
    assert outliers.rank_average_score(one).count() == 1
