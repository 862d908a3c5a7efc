"""Stored quantile sketches: exact while small, bounded rank errors beyond, merged across runs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clearset.operators import sketches

SHARES = {"low": 0.05, "half": 0.5, "high": 0.95}


def test_small_sketches_are_exact(spark):
    df = spark.createDataFrame([(float(x), 1) for x in range(1, 101)] + [(None, 1), (float("nan"), 1)], "x double, y int").repartition(4)
    got = {r["axis"]: r for r in sketches.quantiles(sketches.sketches(df, ["x", "y"]), SHARES).collect()}
    assert [got["x"][k] for k in ("n", "low", "half", "high")] == [100, 5.0, 50.0, 95.0]
    assert [got["y"][k] for k in ("n", "low", "half", "high")] == [102, 1.0, 1.0, 1.0]


@pytest.mark.parametrize("k", [200, 2048])
def test_merged_runs_keep_the_rank_error(spark, tmp_path, k):
    parts = [spark.range(i * 40_000, (i + 1) * 40_000, numPartitions=5).select((F.pmod(F.xxhash64("id"), F.lit(1_000_003)) ** 2).alias("x")) for i in range(4)]
    for i, p in enumerate(parts):
        sketches.store(p, ["x"], str(tmp_path), f"r{i}", k)
    sketches.store(parts[1], ["x"], str(tmp_path), "r1", k)  # a repeated run replaces its own
    every = np.sort(np.concatenate([[r["x"] for r in p.collect()] for p in parts]))
    got = sketches.quantiles(sketches.load(spark, str(tmp_path), k), SHARES).first()
    assert got["n"] == len(every)
    for name, p in SHARES.items():
        low, high = np.searchsorted(every, got[name], "left") / len(every), np.searchsorted(every, got[name], "right") / len(every)
        assert low - sketches.rank_error(k) <= p <= high + sketches.rank_error(k)
    share = sketches.ranks(sketches.load(spark, str(tmp_path), k), {"share": every[len(every) // 4]}).first()["share"]
    assert abs(share - 0.25) <= 2 * sketches.rank_error(k)


def test_no_values_no_sketch(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert sketches.sketches(df, ["x"]).count() == 0
