"""Vector neighbours by nodes and by random projections, against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clearset.operators import outliers, similarity, vector_neighbours as vn


def frame(spark, x, first=0):
    return spark.createDataFrame([(first + i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>").repartition(4)


def lists(df):
    out = {}
    for r in df.orderBy("id", "place").collect():
        out.setdefault(r["id"], []).append((r["nn_id"], round(r["sim"], 9)))
    return out


def recall(got, want):
    return np.mean([len({j for j, _ in got[i]} & {j for j, _ in own}) / len(own) for i, own in want.items()])


def clustered(n, dims, seed=0):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n // 20, dims))[rng.integers(0, n // 20, n)] + 0.2 * rng.normal(size=(n, dims)) + 3.0


@pytest.mark.parametrize("kernel", [similarity.euclidean, similarity.cosine])
def test_nodes_equal_all_pairs_with_many_copies(spark, kernel):
    x = np.round(clustered(120, 5), 6)
    x[20:60] = x[3]
    x[70:74] = x[5]
    df = frame(spark, x)
    want = lists(similarity.nearest(df, df, 4, kernel))
    got = lists(vn.nearest(df, df, 4, kernel))
    for i in want:
        assert [j for j, _ in got[i]] == [j for j, _ in want[i]] or np.allclose([s for _, s in got[i]], [s for _, s in want[i]], atol=1e-6)
        assert len(got[i]) == 4 and i not in [j for j, _ in got[i]]


def test_projected_recall_on_clusters_and_on_the_table(spark, data):
    df = frame(spark, clustered(4000, 32))
    want = lists(similarity.nearest(df.where("id % 8 = 0"), df, 10, similarity.euclidean))
    got = lists(vn.nearest(df.where("id % 8 = 0"), df, 10, similarity.euclidean, vn.projected))
    assert recall(got, want) >= 0.9 and all(len(v) == 10 for v in got.values())
    e = spark.read.parquet(f"{data}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vec"))
    assert recall(lists(vn.nearest(e, e, 10, similarity.cosine, vn.projected)), lists(similarity.nearest(e, e, 10, similarity.cosine))) >= 0.9


def test_few_candidates_are_compared(spark):
    x = clustered(6000, 16, 3)
    q, c = np.random.default_rng(0).normal(size=(16, 48)), x
    seen = sum(len(set(zip(t * np.ones(len(r), int), code))) for t, r, code in vn.codes(c - c.mean(0), q, 8, 0))
    assert seen > 8 * 8  # the buckets of eight tables are in use
    middle = c.mean(0)
    own = {t: code for t, _, code in vn.codes(c - middle, q, 8, 0)}
    visited = np.zeros(len(c))
    for t, r, code in vn.codes(c[:1] - middle, q, 8, 6):
        visited[own[t] == code[0]] = 1
    assert visited.mean() < 0.7


def test_hot_buckets_and_copies_lose_nobody(spark, monkeypatch):
    monkeypatch.setattr(vn, "CELL", 50)
    x = clustered(300, 6, 2)
    x[100:220] = x[0]  # one vector holds more than a third of the rows
    df = frame(spark, np.round(x, 6))
    got = lists(vn.nearest(df, df, 3, similarity.euclidean, vn.projected))
    want = lists(similarity.nearest(df, df, 3, similarity.euclidean))
    assert len(got) == 300 and all(len(v) == 3 for v in got.values()) and recall(got, {i: want[i] for i in want if not 100 <= i < 220 and i}) >= 0.9
    assert all(abs(s) < 1e-3 for i in range(100, 220) for _, s in got[i])


def test_edges(spark):
    one = frame(spark, np.ones((1, 3)))
    for search in (vn.exact, vn.projected):
        assert vn.nearest(one, one, 2, similarity.euclidean, search).count() == 0
        assert lists(vn.nearest(one, frame(spark, np.ones((1, 3)), 7), 2, similarity.euclidean, search)) == {0: [(7, 0.0)]}
    assert vn.nearest(one.where("id > 5"), one, 2, similarity.euclidean).count() == 0
    close = similarity.mean_neighbour_distance(frame(spark, clustered(200, 4)), frame(spark, clustered(200, 4)), 3, approximate=True)
    assert close.count() == 200


def test_a_self_join_meets_each_pair_of_blocks_once(spark):
    x = np.round(clustered(150, 4), 6)
    df = frame(spark, x)
    met = spark.sparkContext.accumulator(0)

    def counted(q, c):
        met.add(1)
        return similarity.euclidean(q, c)

    got = lists(similarity.nearest(df, df, 5, counted, block_rows=40))
    assert met.value == 4 * 5 // 2
    other = df.select("id", "vec")
    want = lists(similarity.nearest(df, other, 5, counted, block_rows=40))
    assert met.value == 10 + 16
    assert {i: [j for j, _ in v] for i, v in got.items()} == {i: [j for j, _ in v] for i, v in want.items()}


def test_outlier_factor_with_thousands_of_copies(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([np.tile(rng.normal(size=3), (10_000, 1)), rng.normal(size=(60, 3))])
    got = {r["id"]: r["lof"] for r in outliers.local_outlier_factor(frame(spark, x), 8).collect()}
    tail = x[9_990:]  # ten copies are as many as eight neighbours need
    d = np.sqrt(((tail[:, None] - tail[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    near = np.argsort(d, axis=1, kind="stable")[:, :8]
    kdist = np.take_along_axis(d, near, 1)[:, -1]
    lrd = 1 / (np.maximum(np.take_along_axis(d, near, 1), kdist[near]).mean(1) + 1e-10)
    want = lrd[near].mean(1) / lrd
    assert len(got) == 10_060 and all(got[i] == pytest.approx(1.0) for i in range(10_000))
    assert [got[9_990 + i] for i in range(10, 70)] == pytest.approx(want[10:].tolist(), rel=1e-6)


def test_approximate_scores_of_whole_jobs(spark):
    x = clustered(400, 6, 4)
    df = frame(spark, x).withColumn("text", F.lit("words"))
    a = outliers.rank_average_score(df, approximate=True).toPandas().set_index("id")["ood_score"]
    e = outliers.rank_average_score(df).toPandas().set_index("id")["ood_score"]
    assert np.corrcoef(a.sort_index(), e.sort_index())[0, 1] > 0.98
    assert outliers.local_outlier_factor(df, 5, approximate=True).count() == 400


def shuffled(spark):
    """Bytes that all stages so far have written to shuffles."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))


def test_blocks_are_not_shuffled_once_for_each_block_they_meet(spark):
    x = np.random.default_rng(8).normal(size=(600, 64))
    df = frame(spark, x)
    once = x.nbytes
    for other in (df, df.select("id", "vec")):
        before = shuffled(spark)
        got = lists(similarity.nearest(df, other, 2, similarity.euclidean, block_rows=20))  # thirty blocks
        assert shuffled(spark) - before < 6 * once
        d = ((x[:, None] - x[None]) ** 2).sum(2)
        np.fill_diagonal(d, np.inf)
        assert {i: [j for j, _ in v] for i, v in got.items()} == {i: np.argsort(d[i], kind="stable")[:2].tolist() for i in range(600)}


def test_ties_and_copies_keep_the_smallest_ids(spark):
    x = np.repeat(np.eye(4), 60, axis=0)  # sixty copies of each of four vectors
    names = [f"n{i:03d}" for i in np.random.default_rng(1).permutation(240)]
    df = spark.createDataFrame([(n, v.tolist()) for n, v in zip(names, x)], "id string, vec array<double>").repartition(3)
    got = lists(similarity.nearest(df, df, 3, similarity.euclidean, block_rows=50))
    for first in range(0, 240, 60):
        own = sorted(names[first : first + 60])
        for n in own:
            assert got[n] == [(m, 0.0) for m in own if m != n][:3]
