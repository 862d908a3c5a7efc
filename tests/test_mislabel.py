"""Fold models that are fitted together, against Spark's own fits one by one."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from clearset.operators import mislabel


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    y = (rng.random(300) < 0.3).astype(int)
    x = rng.normal(size=(300, 5)) * [1, 3, 0.1, 1, 0] + 0.8 * y[:, None] + [0, 5, 0, 0, 7]
    x[:, 4] = 7.0  # a constant column
    data = [(i, v.tolist(), int(a), float(rng.uniform(0.2, 2)), i % 4) for i, (v, a) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "id long, vec array<double>, label int, weight double, fold int").repartition(3).cache()


def one_by_one(train, model, c):
    z = [(F.col("vec")[i] - float(m)) / float(s) for i, (m, s) in enumerate(zip(model.mean, model.dev))]
    n = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    total = sum(n.values())
    w = F.col("weight") * F.when(F.col("label") == 1, total / (2 * n[1])).otherwise(total / (2 * n[0]))
    d = train.select(array_to_vector(F.array(*z)).alias("features"), F.col("label").cast("double").alias("label"), w.alias("w"))
    lr = LogisticRegression(weightCol="w", regParam=1 / (c * d.agg(F.sum("w")).first()[0]), elasticNetParam=0.0, standardization=False, maxIter=500, tol=1e-12)
    fitted = lr.fit(d)
    return np.r_[fitted.coefficients.toArray(), fitted.intercept]


def test_coefficients_equal_single_fits(rows):
    models = mislabel.fit(rows, [0, 1, 2, 3], 0.1)
    for f, m in enumerate(models):
        train = rows.where(F.col("fold") != f)
        x = np.stack([r["vec"] for r in train.collect()])
        assert np.allclose(m.mean, x.mean(0)) and np.allclose(m.dev, np.where(x.std(0) > 1e-12, x.std(0), 1.0))
        assert np.allclose(m.beta, one_by_one(train, m, 0.1), atol=1e-6)


def test_jobs_do_not_grow_with_the_folds(spark, rows):
    def jobs(k):
        spark.sparkContext.setJobGroup(f"folds-{k}", "")
        mislabel.fit(rows.withColumn("fold", (F.col("id") % k).cast("int")), list(range(k)), 0.1)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"folds-{k}"))

    assert jobs(10) <= jobs(2) + 6


def test_partial_sums_of_many_partitions(rows, monkeypatch):
    monkeypatch.setattr(mislabel, "FAN_IN", 2)
    wide = mislabel.fit(rows.repartition(7), [0, 1], 0.1)
    assert np.allclose(wide[1].beta, mislabel.fit(rows.coalesce(1), [0, 1], 0.1)[1].beta, atol=1e-8)


def test_one_label_and_nothing(rows):
    same = mislabel.fit(rows.where("label = 1"), [0], 0.1)[0]
    assert same.probability(np.zeros((1, 5)))[0] == pytest.approx(1.0)
    apart = rows.withColumn("label", (F.col("vec")[1] > 6).cast("int"))  # separable: the penalty keeps it finite
    assert np.isfinite(mislabel.fit(apart, [0, 1], 100.0)[0].beta).all()
    found = mislabel.in_sample(rows)
    assert found.count() == 300 and 0 <= found.agg(F.min("mislabel_score")).first()[0]


def test_tasks_without_rows_add_nothing(rows):
    # 200 rows by a key of two values in twelve partitions: ten tasks have none
    few = rows.where("id < 200").repartition(12, F.col("id") % 2)
    assert np.allclose(mislabel.fit(few, [0], 0.1)[0].beta, mislabel.fit(few.coalesce(1), [0], 0.1)[0].beta, atol=1e-8)
    assert mislabel.in_sample(few).count() == 200
