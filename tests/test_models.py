"""Models over tables: planted label errors, files, streams."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clearset.jobs import scoring
from clearset.operators import mislabel, similarity
from clearset.sources import tables
from clearset.streaming.scores import score_stream, stream_scores


@pytest.fixture(scope="module")
def flipped(spark):
    """200 rows in 16 dimensions, classes 2.0 apart, 20 labels flipped."""
    rng = np.random.default_rng(0)
    y = np.repeat([0, 1], 100)
    x = rng.normal(size=(200, 16)) + 2.0 * y[:, None]
    bad = rng.choice(200, 20, replace=False)
    y[bad] = 1 - y[bad]
    rows = [(i, int(a), v.tolist(), int(rng.integers(2**62)), "t" * int(rng.integers(1, 90))) for i, (a, v) in enumerate(zip(y, x))]
    return spark.createDataFrame(rows, "id long, label int, vec array<double>, hash long, text string"), set(bad.tolist())


def test_flipped_labels_score_highest(flipped):
    df, bad = flipped
    got = {r["id"]: r["mislabel_score"] for r in mislabel.mislabel_scores(df, k=3, iterations=1).collect()}
    top = set(sorted(got, key=got.get, reverse=True)[:20])
    assert len(got) == 200 and len(top & bad) >= 18


def test_excluded_rows_are_scored_by_all_fold_models(spark, flipped):
    df, _ = flipped
    some = df.selectExpr("*", "id % 10 = 0 AS out")
    assert mislabel.out_of_fold(some, k=2, excluded="out").count() == 200


def test_batch_predictions_and_fold_models(spark, flipped):
    df, _ = flipped
    models = {"a": lambda pdf: np.full(len(pdf), 0.25), "b": lambda pdf: np.full(len(pdf), 0.75)}
    got = scoring.predict(df.select("id"), models)
    assert got.count() == 400 and got.groupBy("id").avg("p").select("avg(p)").distinct().collect()[0][0] == 0.5


def test_three_axis_job(spark, flipped, tmp_path):
    df, _ = flipped
    at = [f"vec[{i}] AS {c}" for i, c in enumerate(scoring.HANDCRAFTED)]
    features = df.selectExpr("id", *at, "vec[6] AS zero_shot", "IF(id = 5, 0.5D, 0.0D) AS person_ratio")
    found = scoring.score_all(df, features=features)
    rows = [r for r in found.scores.collect()]
    assert sorted(r["id"] for r in rows) == list(range(200)) and all(0 <= r[c] <= 1 for r in rows for c in ("mislabel_score", "dup_score", "ood_score"))
    own = {r["id"]: r for r in found.features.collect()}
    assert len(own) == 200 and own[5]["ood_score"] == max(r["ood_score"] for r in own.values())
    assert all(own[r["id"]]["ood_score"] == r["ood_score"] for r in rows)
    scoring.write_tables(found, str(tmp_path / "tables"))
    assert spark.read.parquet(str(tmp_path / "tables" / "diagnostics")).count() == 200
    assert set(own[0].asDict()) == {"id", "label", "ood_score", "ood_score_handcrafted", "zero_shot", *scoring.HANDCRAFTED}
    plain = scoring.score_all(df)
    assert plain.features is None and plain.scores.count() == 200


def test_stream_equals_batch(spark, flipped, tmp_path):
    df, _ = flipped
    train, test = df.where("id % 4 <> 0"), df.where("id % 4 = 0").drop("label")
    test.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(test.schema).parquet(str(tmp_path / "in"))
    q = score_stream(stream, train.select("id", "vec", "hash", "text"), str(tmp_path / "out"), str(tmp_path / "state"))
    q.awaitTermination(120)
    got = {r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {r["id"] for r in test.collect()}
    close = lambda d: {r["id"]: (round(r["dup_score"], 9), round(r["ood_score"], 9)) for r in d.collect()}
    want = close(scoring.cross_set_scores(train, test))
    assert close(stream_scores(train, str(tmp_path / "out"))) == want and len(want) == 50


def png(path, rgb):
    h, w, _ = rgb.shape
    raw = b"".join(b"\0" + rgb[i].tobytes() for i in range(h))
    part = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b""))


def test_readers(spark, tmp_path):
    for i in range(2):
        png(tmp_path / f"train_{i}.png", np.full((6, 4, 3), 40 * i, np.uint8))
    (tmp_path / "broken.png").write_bytes(b"not an image")
    got = tables.read_images(spark, str(tmp_path / "*.png"))
    assert {(r["id"], r["height"], r["width"]) for r in got.collect()} == {("train_0", 6, 4), ("train_1", 6, 4)}
    for m in ("x", "y"):
        (tmp_path / f"{m}.csv").write_text("id,dusty_prob\ntest_0,0.5\n")
    assert {r["model"] for r in tables.read_predictions(spark, str(tmp_path / "*.csv")).collect()} == {"x", "y"}
    (tmp_path / "l.csv").write_text("id,label\ntrain_0,1\n")
    assert tables.read_labels(spark, str(tmp_path / "l.csv")).first()["label"] == 1


def test_unreadable_images_get_the_default_of_each_signal(spark, tmp_path):
    rng = np.random.default_rng(1)
    for i in range(30):
        png(tmp_path / f"train_{i:02}.png", rng.integers(0, 255, (40, 40, 3)).astype(np.uint8) // (1 + i % 2))
    (tmp_path / "train_30.png").write_bytes(b"not an image")
    labels = spark.createDataFrame([(f"train_{i:02}", i % 2) for i in range(32)], "id string, label int")  # the last one has no file
    files = tables.read_images(spark, str(tmp_path / "*.png"), keep_invalid=True)
    assert {r["id"] for r in files.where("NOT decoded").collect()} == {"train_30"}
    rows = scoring.image_rows(labels, files)
    bad = {r["id"]: r for r in rows.where("NOT decoded").collect()}
    assert set(bad) == {"train_30", "train_31"}
    assert all(r["vec"] is None and r["hash"] is None and r["skin_ratio"] == 0.0 and r["brightness"] == 0.0 for r in bad.values())
    vectors = rows.select("id", F.col("vec").cast("array<double>").alias("vec"))
    prompts = vectors.where("id < 'train_03'").select(F.col("id").alias("prompt"), (F.col("id") == "train_00").alias("positive"), "vec")
    features = rows.drop("vec").join(similarity.zero_shot(vectors, prompts), "id").withColumn("watermark_ratio", F.lit(0.0)).withColumn("ocr_text_length", F.lit(0))
    assert {r["zero_shot"] for r in features.where("NOT decoded").collect()} == {0.5}
    given = rows.select("id", "label", "hash", F.col("vec").cast("array<double>").alias("vec"), F.lit("").alias("text"))
    for found in (scoring.score_all(given, features=features), scoring.score_all(given)):
        got = {r["id"]: r for r in found.scores.collect()}
        assert len(got) == 32 and all(None not in tuple(r) for r in got.values())
        assert all((got[i]["dup_score"], got[i]["mislabel_score"]) == (0.0, 0.5) for i in bad)
    assert all(got[i]["ood_score"] == 0.5 for i in bad)


def test_exported_files_are_bounded_and_counted(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i in range(60):
        (source / f"img_{i}.jpg").write_bytes(bytes([i]) * 1000)
    (source / "stray.jpg").write_bytes(b"x")
    routes = spark.createDataFrame([(f"img_{i}", "train", "clean") if i % 6 else (f"img_{i}", "excluded", "dup") for i in range(66)], "id string, split string, bucket string")
    files = tables.read_files(spark, str(source))
    report = tables.export_files(routes, files, str(tmp_path / "out"), file_bytes=5000)
    assert {(r["split"], r["bucket"], r["copied"], r["missing"]) for r in report.collect()} == {("train", "clean", 50, 5), ("excluded", "dup", 10, 1)}
    written = spark.read.parquet(str(tmp_path / "out"))
    assert all(r["content"] == bytes([int(r["id"][4:])]) * 1000 for r in written.collect()) and written.count() == 60
    sizes = written.groupBy(F.input_file_name()).agg(F.sum("length").alias("n")).collect()
    assert max(r["n"] for r in sizes) <= 4 * 5000 and len(sizes) >= 6
    assert tables.export_files(routes.where("id = 'img_65'"), files, str(tmp_path / "none")).collect()[0]["missing"] == 1
