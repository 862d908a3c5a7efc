"""Scores of rows that arrive in parts: the same however they are cut."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clearset.jobs import reference, scoring
from clearset.operators import ranking
from clearset.streaming.scores import score_stream, stream_scores


@pytest.fixture(scope="module")
def sets(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(90, 6)), 3)
    # near hashes across the parts, some equal, and rows without hash, vector or text
    base = [int(h) for h in rng.integers(1 << 62, size=30)]
    rows = [(i, x[i].tolist(), base[i % 30] ^ (1 << (i % 7) if i > 60 else 0), "t" * int(rng.integers(1, 40)), "clash") for i in range(90)]
    rows[60] = (60, None, base[0], "no vector", "clash")
    rows[61] = (61, rows[61][1], None, None, "clash")
    df = spark.createDataFrame(rows, "id long, vec array<double>, hash long, text string, dist string")
    return df.where("id < 50"), df.where("id >= 50")


def close(df):
    return {r["id"]: tuple(None if v is None else round(v, 9) for v in (r["dup_score"], r["ood_score"])) for r in df.collect()}


@pytest.mark.parametrize("cuts", [[50, 51, 75, 90]])
def test_parts_equal_the_whole(spark, sets, tmp_path, cuts):
    train, test = sets
    ref = reference.fit(train, str(tmp_path / "ref"), k=3)
    log = str(tmp_path / "log")
    assert reference.current_scores(ref, log).count() == 0 == reference.fitted_scores(ref, log).count()
    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
        reference.absorb(ref, test.where(F.col("id").between(a, b - 1)), log, n)
    reference.absorb(ref, test.where(F.col("id").between(cuts[-2], cuts[-1] - 1)), log, len(cuts) - 2)  # once more
    got = close(reference.current_scores(ref, log))
    assert got == close(scoring.cross_set_scores(train, test, k=3)) and len(got) == 40
    assert got[61][0] is None and got[60][1] is None
    fitted = close(reference.fitted_scores(ref, log))
    whole = str(tmp_path / "whole")
    reference.absorb(ref, test, whole, 0)
    assert fitted == close(reference.fitted_scores(ref, whole)) and len(fitted) == 40
    assert all(v is None or 0 <= v <= 1 for r in fitted.values() for v in r) and fitted[60][1] is None


def test_a_fitted_set_stands_and_the_stream_reads_it(spark, sets, tmp_path):
    train, test = sets
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    test.repartition(5, "id").write.parquet(src)
    rows = spark.readStream.schema(test.schema).option("maxFilesPerTrigger", 2).parquet(src)
    score_stream(rows, train, out, str(tmp_path / "state"), k=3).awaitTermination(240)
    assert spark.read.parquet(out).select("part").distinct().count() > 1
    assert close(stream_scores(train, out, k=3)) == close(scoring.cross_set_scores(train, test, k=3))
    before = stream_scores(train, out, k=3, fitted=True).orderBy("id").collect()
    assert stream_scores(train.where("id < 9"), out, k=3, fitted=True).orderBy("id").collect() == before


def test_wide_hashes_and_string_ids(spark, tmp_path):
    rows = [(f"r{i}", [float(i), 1.0], [i, 7], "x" * (i % 5)) for i in range(24)]
    df = spark.createDataFrame(rows, "id string, vec array<double>, hash array<long>, text string")
    train, test = df.where("id < 'r2'"), df.where("id >= 'r2'")
    ref = reference.fit(train, str(tmp_path / "ref"), k=2, bits=128)
    for n, part in enumerate((test.where("id < 'r3'"), test.where("id >= 'r3'"), test.limit(0))):
        reference.absorb(ref, part, str(tmp_path / "log"), n)
    assert close(reference.current_scores(ref, str(tmp_path / "log"))) == close(scoring.cross_set_scores(train, test, k=2, bits=128))


def test_cumulative_shares_are_bounded_and_near(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=3000), 2)
    df = spark.createDataFrame([(float(v), float(i % 3)) for i, v in enumerate(x)], "a double, b double")
    got = ranking.cumulative_shares(df, ["a", "b"], steps=64).toPandas()
    a = got[got["feature"] == 0].sort_values("x")
    assert len(a) <= 65 and len(got[got["feature"] == 1]) == 3
    for r in a.itertuples():
        assert r.share == pytest.approx(((x < r.x).sum() + ((x == r.x).sum() + 1) / 2) / 3000)
    gaps = np.diff(a["share"].to_numpy())
    assert (gaps > 0).all() and gaps.max() < 2 / 64
