"""Checks of a result table before it is handed on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns of the two kinds of tables; tables of other kinds are checked for ids only.
KINDS = {"predictions": ["id", "dusty_prob"], "scores": ["id", "mislabel_score", "dup_score", "ood_score"]}


def violations(df: DataFrame, kind: str) -> DataFrame:
    """(rule, n): broken rules only.  Columns have to be exactly those of the kind, scores
    neither null nor outside 0 .. 1, ids unique and not null."""
    spark = df.sparkSession
    want = KINDS.get(kind)
    found = []
    if want and set(df.columns) != set(want):
        found.append(("columns", len(set(df.columns) ^ set(want))))
    scores = [c for c in (want or [])[1:] if c in df.columns]
    checks = {f"null:{c}": F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))) for c in scores}
    checks |= {f"range:{c}": F.count_if((F.col(c) < 0) | (F.col(c) > 1)) for c in scores}
    if "id" in df.columns:
        checks["null:id"] = F.count_if(F.col("id").isNull())
    rows = df.agg(*[v.alias(k) for k, v in checks.items()]) if checks else None
    out = spark.createDataFrame(found, "rule string, n long")
    if rows is not None:
        out = out.unionByName(rows.select(F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(f"`{k}`").alias("n")) for k in checks])).alias("r")).select("r.*"))
    if "id" in df.columns:
        repeats = df.where(F.col("id").isNotNull()).groupBy("id").agg((F.count("*") - 1).alias("n"))
        out = out.unionByName(repeats.agg(F.lit("repeated:id").alias("rule"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")))
    return out.where("n > 0")
