"""Nearest hashes by growing radius, and hot bands, against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from clearset.operators import bands, dedup, hash_neighbours, similarity


def signed(h):
    return h - (1 << 64) if h >= 1 << 63 else h


def distance(a, b):
    a, b = (x if isinstance(x, list) else [x] for x in (a, b))
    return sum(bin((x ^ y) & ((1 << 64) - 1)).count("1") for x, y in zip(a, b))


def wanted(queries, candidates):
    out = {}
    for i, h in queries:
        tries = [] if h is None else [(distance(h, g), j) for j, g in candidates if g is not None and j != i]
        out[i] = min(tries)[::-1] if tries else (None, None)
    return out


def found(df):
    rows = df.collect()
    assert len({r["id"] for r in rows}) == len(rows)
    return {r["id"]: (r["nn_id"], r["dist"]) for r in rows}


def planted(seed, n, bits=64, far=0.2):
    rng = random.Random(seed)
    base = [rng.getrandbits(bits) for _ in range(max(1, n // 6))]
    out = []
    for i in range(n):
        h = rng.getrandbits(bits) if rng.random() < far else rng.choice(base)
        for _ in range(rng.choice([0, 0, 1, 2, 3, 6, 11])):
            h ^= 1 << rng.randrange(bits)
        out.append((i, None if i % 29 == 5 else h))
    return out


@pytest.mark.parametrize("rounds,width", [(3, None), (1, 16), (2, 8), (3, 13)])
def test_equals_all_pairs(spark, rounds, width):
    rows = [(i, None if h is None else signed(h)) for i, h in planted(rounds, 220)]
    df = spark.createDataFrame(rows, "id long, hash long").repartition(3)
    assert found(hash_neighbours.nearest_hash(df, df, rounds=rounds, width=width)) == wanted(rows, rows)


def test_words_of_256_bits_and_other_candidates(spark):
    split = lambda h: None if h is None else [signed((h >> (64 * k)) & ((1 << 64) - 1)) for k in range(4)]
    rows = [(i, split(h)) for i, h in planted(9, 160, 256, 0.1)]
    q, c = rows[::3], rows[1::2]
    make = lambda r: spark.createDataFrame(r, "id long, hash array<long>")
    assert found(hash_neighbours.nearest_hash(make(q), make(c), bits=256)) == wanted(q, c)


def test_few_rows_reach_the_blocks(spark):
    rng = random.Random(1)
    rows = [(signed(rng.getrandbits(64)),) for _ in range(3000)]
    near = [(signed((h ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64)) & ((1 << 64) - 1)),) for (h,) in rows]
    hashes = spark.createDataFrame(rows + near, "h long").distinct()
    settled, rest = hash_neighbours.by_radius(hashes, hashes.withColumn("first", F.col("h")), 64)
    assert settled.count() + rest.count() == hashes.count() and rest.count() < 0.01 * hashes.count()


def test_nothing_and_single_rows(spark):
    df = spark.createDataFrame([(1, 5), (2, None)], "id long, hash long")
    assert found(hash_neighbours.nearest_hash(df, df)) == {1: (None, None), 2: (None, None)}
    assert hash_neighbours.nearest_hash(df.where("id > 9"), df).count() == 0
    assert found(hash_neighbours.nearest_hash(df, df.where("id > 9"))) == {1: (None, None), 2: (None, None)}


def test_hot_bands_lose_no_pair(spark, monkeypatch):
    monkeypatch.setattr(bands, "HEAVY", 20)
    monkeypatch.setattr(bands, "CELL", 16)
    rng = random.Random(2)
    rows = [(i, signed((rng.getrandbits(10) << 48) | (rng.getrandbits(4)))) for i in range(250)]  # the middle bits are zero
    df = spark.createDataFrame(rows, "id long, hash long").repartition(3)
    got = {(r["id_a"], r["id_b"], r["dist"]) for r in similarity.hamming_pairs(df, 3).collect()}
    assert got == {(i, j, distance(g, h)) for i, g in rows for j, h in rows if i < j and distance(g, h) <= 3}
    assert found(hash_neighbours.nearest_hash(df, df)) == wanted(rows, rows)
    clusters = {r["id"]: r["cluster"] for r in dedup.duplicate_clusters(df, 1).collect()}
    assert len(clusters) == 250


def test_a_hundred_thousand_hashes_under_one_band_key(spark):
    # bits above the 40th are constant: with two bands every hash has the same upper one
    n = 100_000
    key = F.pmod(F.xxhash64("id"), F.lit(1 << 31))
    df = spark.range(n).select("id", F.shiftleft(key, 1).alias("hash"))
    twins = df.where("id % 1000 = 0").select((F.col("id") + n).alias("id"), F.col("hash").bitwiseXOR(F.lit(1)).alias("hash"))
    seen = spark.sparkContext.accumulator(0)
    sizes = []

    def watched(most):
        compare = plain(most)

        def run(a, b):
            assert len(a) <= 2 * bands.CELL and len(b) <= 2 * bands.CELL
            seen.add(1)
            return compare(a, b)

        return run

    plain = similarity.pairs_within
    similarity.pairs_within = watched
    try:
        near = similarity.near_hashes(df.unionByName(twins), 1)
        sizes = {r["dist"]: r["count"] for r in near.groupBy("dist").count().collect()}
    finally:
        similarity.pairs_within = plain
    assert seen.value > 200 and sizes[1] >= twins.join(df, twins["hash"].bitwiseXOR(F.lit(1)) == df["hash"]).select(twins["hash"]).distinct().count()


def test_common_bands_and_many_keys_take_no_rounds(spark, monkeypatch):
    rng = random.Random(4)
    words = lambda common: [signed(rng.getrandbits(64)) if not common else signed(1 << rng.randrange(64)) for _ in range(4)]
    make = lambda rows: spark.createDataFrame([(i, h) for i, h in enumerate(rows)], "first long, h array<long>")
    apart, flat = make([words(False) for _ in range(300)]), [words(True) for _ in range(300)]
    assert hash_neighbours.search_rounds(apart, 256, width=13) == 2  # a third one would take 1,512 keys a hash
    assert hash_neighbours.search_rounds(apart, 256, width=4) == 3
    monkeypatch.setattr(hash_neighbours, "HEAVY", 1)
    assert hash_neighbours.search_rounds(make(flat), 256) == 0
    rows = list(enumerate(flat))
    df = spark.createDataFrame(rows, "id long, hash array<long>")
    assert found(hash_neighbours.nearest_hash(df, df, bits=256)) == wanted(rows, rows)


def test_exploded_hashes_are_not_broadcast(spark):
    rng = random.Random(5)
    hashes = spark.createDataFrame([(signed(rng.getrandbits(64)), i) for i in range(200)], "h long, first long")
    seen = []

    def watched(left, right, light, *rest, **named):
        seen.append(light(left, right)._jdf.queryExecution().executedPlan().toString())
        return meet(left, right, light, *rest, **named)

    meet, hash_neighbours.meet = hash_neighbours.meet, watched
    try:
        hash_neighbours.by_radius(hashes.select("h"), hashes, 64)
    finally:
        hash_neighbours.meet = meet
    assert seen and not any("BroadcastHashJoin" in plan for plan in seen)
