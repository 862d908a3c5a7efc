"""Small hand-made frames: ties, nulls, single rows, constant columns."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clearset.operators import cleaning, components, dedup, diagnostics, images, metrics, outliers, ranking, similarity, validate


def by_id(df, *cols):
    return {r["id"]: (r[cols[0]] if len(cols) == 1 else tuple(r[c] for c in cols)) for r in df.collect()}


def test_ordinal_and_average_ranks_with_ties_and_nulls(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 5.0), (3, 1.0), (4, None), (5, 9.0)], "id long, x double")
    got = by_id(ranking.ordinal_rank(df, "x", "r"), "r")
    assert [round(got[i] * 4) for i in (3, 1, 2, 5, 4)] == [0, 1, 2, 3, 4]
    assert by_id(ranking.average_rank(df, "x", "r"), "r") == {1: 2.5, 2: 2.5, 3: 1.0, 4: None, 5: 4.0}
    assert by_id(ranking.average_rank(df, "x", "r", True), "r") == {1: 2.5, 2: 2.5, 3: 4.0, 4: None, 5: 1.0}


def test_ranks_do_not_depend_on_partitions(spark):
    random.seed(3)
    rows = [(i, float(random.randint(0, 9))) for i in range(300)]
    one = spark.createDataFrame(rows, "id long, x double")
    many = one.repartition(17)
    assert by_id(ranking.ordinal_rank(one, "x", "r"), "r") == by_id(ranking.ordinal_rank(many, "x", "r"), "r")
    assert by_id(ranking.average_rank(one, "x", "r"), "r") == by_id(ranking.average_rank(many, "x", "r"), "r")


def test_single_row_and_constant_column(spark):
    one = spark.createDataFrame([(1, 4.0)], "id long, x double")
    assert by_id(ranking.ordinal_rank(one, "x", "r"), "r") == {1: 0.0}
    assert by_id(ranking.min_max(one, "x", "s"), "s") == {1: 0.0}
    assert [r["n"] for r in diagnostics.histogram(one, "x", 3).orderBy("bin").collect()] == [1, 0, 0]
    flat = diagnostics.flatness(spark.createDataFrame([(i, 1.0) for i in range(5)], "id long, x double"), ["x"]).first()
    assert flat["flat"] and flat["tied"] and flat["max_count"] == 5


def test_unknown_column_of_a_top_list_is_an_error(spark):
    with pytest.raises(ValueError):
        ranking.top_n(spark.range(3), "no", 1)


def test_folds_are_balanced_and_small_classes_reduce_them(spark):
    df = spark.createDataFrame([(i, int(i < 10)) for i in range(100)], "id long, label int")
    counts = {(r["label"], r["fold"]): r["count"] for r in ranking.stratified_folds(df, 5).groupBy("label", "fold").count().collect()}
    assert counts == {(0, f): 18 for f in range(5)} | {(1, f): 2 for f in range(5)}
    assert ranking.effective_folds(df.where("label = 0 OR id < 3"), 5) == 3
    assert ranking.effective_folds(df.where("label = 0 OR id < 1"), 5) == 2


def hashes(seed, n=160):
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(12)]
    out = []
    for i in range(n):
        h = rng.choice(base)
        for _ in range(rng.choice([0, 0, 1, 2, 4, 6])):
            h ^= 1 << rng.randrange(64)
        out.append((i, None if i % 23 == 7 else h - (1 << 64) if h >= 1 << 63 else h))
    return out


def distance(a, b):
    return bin((a ^ b) & ((1 << 64) - 1)).count("1")


@pytest.mark.parametrize("limit", [0, 2, 5])
def test_banding_equals_brute_force(spark, limit):
    rows = hashes(1)
    got = {(r["id_a"], r["id_b"], r["dist"]) for r in similarity.hamming_pairs(spark.createDataFrame(rows, "id long, hash long"), limit).collect()}
    known = [(i, h) for i, h in rows if h is not None]
    assert got == {(i, j, distance(g, h)) for i, g in known for j, h in known if i < j and distance(g, h) <= limit}


@pytest.mark.parametrize("seed", [1, 2])
def test_greedy_dedup_equals_the_sequential_loop(spark, seed):
    rows = hashes(seed)
    got = {r["id"]: (r["leader"], r["dist"]) for r in dedup.greedy_dedup(spark.createDataFrame(rows, "id long, hash long"), 4).collect()}
    want, gone = {}, set()
    for i, g in rows:
        if g is None or i in gone:
            continue
        for j, h in rows[i + 1 :]:
            if h is not None and j not in gone and distance(g, h) <= 4:
                want[j] = (i, distance(g, h))
                gone.add(j)
    assert got == want


def test_clusters_equal_union_find(spark):
    rows = hashes(4)
    got = by_id(dedup.duplicate_clusters(spark.createDataFrame(rows, "id long, hash long"), 4), "cluster")
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, g in rows:
        for j, h in rows:
            if i < j and g is not None and h is not None and distance(g, h) <= 4:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert got == {i: root(i) for i, _ in rows}


def test_components_of_a_long_chain_and_of_nothing(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 100), (None, 3)], "u long, v long")
    assert {r["node"]: r["component"] for r in components.connected_components(chain).collect()} == {i: 0 for i in range(61)}
    assert components.connected_components(chain.limit(0)).count() == 0


def test_blocks_equal_one_block(spark):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(90, 6)))], "id long, vec array<double>")
    rows = lambda n: sorted((r["id"], r["place"], r["nn_id"]) for r in similarity.nearest(df, df, 4, similarity.euclidean, block_rows=n).collect())
    assert rows(17) == rows(1000)


def test_a_row_without_a_hash_has_no_duplicate(spark):
    df = spark.createDataFrame([(1, 7), (2, None), (3, 7)], "id long, hash long")
    assert by_id(similarity.dup_scores(df), "nn_id", "dup_score") == {1: (3, 1.0), 2: (None, 0.0), 3: (1, 1.0)}


def test_cleaning_precedence(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "id long, label int")
    scores = spark.createDataFrame([(i, i / 20, i / 20, i / 20) for i in range(19)], "id long, mislabel_score double, dup_score double, ood_score double")
    got = by_id(cleaning.clean_train_set(labels, scores, 90, 50, 50, mode="exclude"), "exclude_reason")
    assert got[18] == got[17] == "ood" and got[19] is None
    assert got[16] == "mislabel" and got[15] == "dup"


def test_average_precision_and_auc_edges(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.8, 1), (0.1, 0)], "s double, y int")
    assert metrics.average_precision(df, "s", "y").first()["ap"] == pytest.approx(0.5 * 1 + 0.5 * 2 / 3)
    assert metrics.roc_auc(df, "s", "y").first()["auc"] == pytest.approx(0.875)
    none = df.withColumn("y", F.lit(0))
    assert metrics.average_precision(none, "s", "y").first()["ap"] is None
    assert metrics.roc_auc(none, "s", "y").first()["auc"] is None


def test_validation_finds_each_violation(spark):
    good = spark.createDataFrame([("a", 0.1), ("b", 1.0)], "id string, dusty_prob double")
    assert validate.violations(good, "predictions").count() == 0
    bad = spark.createDataFrame([("a", -0.1, 1), ("a", 1.1, 1), (None, None, 1)], "id string, dusty_prob double, extra int")
    assert {r["rule"]: r["n"] for r in validate.violations(bad, "predictions").collect()} == {"columns": 1, "null:dusty_prob": 1, "range:dusty_prob": 2, "null:id": 1, "repeated:id": 1}
    assert {r["rule"] for r in validate.violations(bad, "other").collect()} == {"null:id", "repeated:id"}


def test_isolation_forest_ranks_planted_outliers_first(spark):
    rng = np.random.default_rng(1)
    x = np.r_[rng.normal(size=(200, 5)), rng.normal(size=(4, 5)) + 9]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, vec array<double>")
    top = outliers.isolation_forest(df, 0.02, trees=40).orderBy(F.desc("suspicion_score")).limit(4)
    assert {r["id"] for r in top.collect()} == {200, 201, 202, 203}


def test_image_features(spark):
    flat = np.full((32, 32, 3), 50, np.uint8)
    half = flat.copy()
    half[:, :16] = (120, 150, 210)  # BGR of a skin tone
    rng = np.random.default_rng(0)
    noise = rng.integers(0, 255, (40, 40, 3), dtype=np.uint8)
    rows = [(str(i), x.shape[0], x.shape[1], 3, bytearray(x.tobytes())) for i, x in enumerate([flat, half, noise])] + [("bad", 5, 5, 3, bytearray(b"x"))]
    df = spark.createDataFrame(rows, "id string, height int, width int, n_channels int, data binary")
    got = {r["id"]: r for r in images.image_features(df).collect()}
    assert got["0"]["brightness"] == pytest.approx(50) and got["0"]["patch_std"] == 0 and got["0"]["dark_blue_gray"] == 1
    assert got["1"]["skin_ratio"] == 0.5 and got["1"]["patch_std"] > 0
    assert got["bad"]["hash"] is None and got["bad"]["brightness"] == 0
    assert bin(got["2"]["hash"][0] & (2**64 - 1)).count("1") == 32  # half of the bits lie above the median
    small = images.prepare(df.where("id = '2'"), lambda x: images.thumbnail(x, 20)).first()
    assert (small["height"], small["width"]) == (20, 20)
    assert images.prepare(df.where("id = '2'"), images.residual).first()["n_channels"] == 1


def test_mask_coverage(spark):
    rows = [("a", 1, 0.9, bytearray([1, 0, 0, 0]), 2, 2), ("a", 1, 0.8, bytearray([0, 1, 0, 0]), 2, 2), ("a", 1, 0.5, bytearray([1] * 4), 2, 2), ("b", 2, 0.9, bytearray([1] * 4), 2, 2)]
    df = spark.createDataFrame(rows, "id string, det_label int, det_score double, mask binary, height int, width int")
    ids = spark.createDataFrame([("a",), ("b",)], "id string")
    assert by_id(outliers.mask_coverage(df, ids), "person_ratio") == {"a": 0.5, "b": 0.0}


def test_hashes_of_four_words(spark):
    rng = np.random.default_rng(5)
    centers = rng.integers(-(2**63), 2**63 - 1, (12, 4))
    rows = []
    for i in range(120):
        words = [int(w) for w in centers[rng.integers(12)]]
        for bit in rng.integers(0, 256, rng.integers(0, 4)):
            words[bit // 64] ^= -(1 << 63) if bit % 64 == 63 else 1 << int(bit % 64)
        rows.append((i, None if i % 40 == 7 else words))
    df = spark.createDataFrame(rows, "id long, hash array<long>")
    wide = lambda g, h: sum(((a ^ b) & (2**64 - 1)).bit_count() for a, b in zip(g, h))
    known = [(i, h) for i, h in rows if h is not None]
    want = {(i, j): wide(g, h) for i, g in known for j, h in known if i < j and wide(g, h) <= 4}
    assert {(r["id_a"], r["id_b"]): r["dist"] for r in similarity.hamming_pairs(df, 4, bits=256).collect()} == want
    leaders, gone = {}, set()
    for i, _ in known:
        if i not in gone:
            for (a, b), d in sorted(want.items()):
                if a == i and b not in gone:
                    leaders[b] = (i, d)
                    gone.add(b)
    assert {r["id"]: (r["leader"], r["dist"]) for r in dedup.greedy_dedup(df, 4, bits=256).collect()} == leaders
    clusters = by_id(dedup.duplicate_clusters(df, 4, bits=256), "cluster")
    assert all(clusters[a] == clusters[b] for a, b in want) and clusters[7] == 7
    scores = by_id(similarity.dup_scores(df, 256), "dup_score")
    assert scores[7] == 0
    for i, g in known:
        assert scores[i] == pytest.approx(1 - min(wide(g, h) for j, h in known if j != i) / 256)


def test_image_hashes_feed_the_duplicate_axis(spark):
    vectors = spark.createDataFrame([(i, [float((i // 2 * 37 + j * (i // 2 + 3)) % 11 - 5) / 10 for j in range(64)]) for i in range(12)], "id long, vec array<double>")
    found = images.image_features(images.rasters_from_vectors(vectors), 16).select("id", "hash")
    assert {len(r["hash"]) for r in found.collect()} == {4}
    assert {r["id"]: r["leader"] for r in dedup.greedy_dedup(found, 4, bits=256).collect() if r["id"] % 2}.items() >= {i: i - 1 for i in range(1, 12, 2)}.items()
    assert all(s == 1 for s in by_id(similarity.dup_scores(found, 256), "dup_score").values())
