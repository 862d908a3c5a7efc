"""Broadcast sides are measured, whatever was selected from them."""

import pytest
from pyspark.sql import functions as F

from clearset import storage


def hinted(df):
    left = df.sparkSession.range(5).withColumnRenamed("id", "k")
    plan = left.join(df, F.col("k") == F.col(df.columns[0]))._jdf.queryExecution().executedPlan().toString()
    return "broadcast" if "BroadcastHashJoin" in plan else "merge" if "SortMergeJoin" in plan else plan


def test_a_wide_table_stays_unbroadcast_after_a_select(spark):
    wide = storage.materialize(spark.range(3000).select("id", F.lit("x" * 2000).alias("text")), "wide")
    assert hinted(storage.checked_broadcast(wide, max_bytes=1 << 20)) == "merge"
    assert hinted(storage.checked_broadcast(wide.select(F.col("id").alias("other"), "text"), max_bytes=1 << 20)) == "merge"
    assert hinted(storage.checked_broadcast(wide.select("id"), max_bytes=1 << 20)) == "broadcast"
    assert hinted(storage.checked_broadcast(wide.select("id"), max_rows=2999)) == "merge"
    storage.release(wide)


@pytest.mark.parametrize(
    "cell,least,most",
    [
        ("id", 8, 8),
        ("repeat('ab', 500)", 1000, 1030),
        ("sequence(1, 100)", 800, 830),
        ("transform(sequence(1, 10), x -> repeat('é', 50))", 1000, 1300),
        ("transform(sequence(1, 10), x -> struct(x as word, x as bits))", 160, 400),
        ("map('k', repeat('v', 300))", 300, 400),
        ("named_struct('a', repeat('v', 300), 'b', cast(null as string))", 300, 350),
        ("cast(null as array<string>)", 8, 8),
    ],
)
def test_measured_bytes(spark, cell, least, most):
    rows, size = storage.measured(spark.range(7).select(F.expr(cell).alias("a.b")))
    assert rows == 7 and least <= size / 7 - 16 <= most


def test_nothing_has_no_bytes(spark):
    assert storage.measured(spark.range(0).select("id", F.lit("x"))) == (0, 0)
