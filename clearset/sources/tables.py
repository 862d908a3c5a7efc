"""Typed readers and file listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearset.storage import materialize, release

LABELS = "id string, label int"
SCORES = "id string, mislabel_score double, dup_score double, ood_score double"
PREDICTIONS = "id string, dusty_prob double"
EXTENSIONS = ("", ".jpg", ".jpeg", ".png")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=LABELS)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=SCORES)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """(id, dusty_prob, model); ``path`` may be a glob, the file's name is the model's."""
    name = F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.csv)?$", 1)
    return spark.read.csv(path, header=True, schema=PREDICTIONS).withColumn("model", name)


def read_images(spark: SparkSession, path: str, keep_invalid: bool = False) -> DataFrame:
    """(id, origin, height, width, n_channels, data) of the images that could be decoded.
    ``keep_invalid``: of every file, with decoded (false for those that could not: their size is -1
    and their data empty), so that each signal can give them its default."""
    rows = spark.read.format("image").option("dropInvalid", False).load(path).select("image.*")
    stem = F.regexp_extract("origin", r"([^/]+?)\.[^./]*$", 1)
    decoded = F.coalesce(F.col("height") > 0, F.lit(False))
    d = rows.select(stem.alias("id"), "origin", "height", "width", F.col("nChannels").alias("n_channels"), "data", decoded.alias("decoded"))
    return d if keep_invalid else d.where("decoded").drop("decoded")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(id, path, length, content) of files as they are; the id is the name without its suffix."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.regexp_extract("path", r"([^/]+?)(?:\.[^./]*)?$", 1).alias("id"), "path", "length", "content")


def resolve_ids(ids: DataFrame, listing: DataFrame) -> DataFrame:
    """(id, path) of the first that exists: the id itself, then with .jpg, .jpeg, .png.  Ids
    that resolve to nothing have a null path."""
    tries = F.array(*[F.struct(F.lit(i).alias("order"), F.concat("id", F.lit(e)).alias("path")) for i, e in enumerate(EXTENSIONS)])
    found = ids.select("id", F.explode(tries).alias("t")).select("id", "t.*").join(listing.select("path").distinct(), "path")
    best = found.groupBy("id").agg(F.min_by("path", "order").alias("path"))
    return ids.select("id").join(best, "id", "left")


def export(routes: DataFrame, path: str) -> None:
    """Write (split, bucket, ...) as one folder for each split and bucket."""
    routes.write.partitionBy("split", "bucket").parquet(path)


#: About how many bytes of content one written file holds.
FILE_BYTES = 128 << 20


def export_files(routes: DataFrame, files: DataFrame, path: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Copy the ``files`` (id, length, content) that ``routes`` (id, split, bucket) name below ``path``, one
    folder for each split and bucket, and report (split, bucket, copied, missing).

    Buckets are cut into parts by their bytes, so that a large one is spread over many tasks and each
    written file holds about ``file_bytes``.  ``copied`` counts what was written; ids of the routes that
    have no file are ``missing``.  A file whose id has no route is not copied; of files that share
    an id all are.
    """
    routes = materialize(routes.select("id", "split", "bucket"), "export-routes")
    sized = routes.join(files.select("id", "length"), "id")  # contents are not read for this
    totals = sized.groupBy("split", "bucket").agg(F.sum("length").alias("bytes"), F.count("*").alias("n"))
    parts = F.greatest(F.ceil(F.col("bytes") / F.lit(file_bytes)), F.lit(1)).cast("int")
    totals = materialize(totals.select("split", "bucket", parts.alias("parts"), F.ceil(F.col("n") / parts).cast("long").alias("rows")), "export-sizes")  # one row a bucket
    most = totals.agg(F.max("rows"), F.sum("parts")).first()
    d = files.join(routes, "id").join(F.broadcast(totals.select("split", "bucket", "parts")), ["split", "bucket"])
    d = d.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts"))).repartition(max(1, most[1] or 0), "split", "bucket", "part")
    # two parts that meet in one task must not make one file of twice the size
    d.drop("parts", "part").write.option("maxRecordsPerFile", max(1, 2 * (most[0] or 1))).partitionBy("split", "bucket").parquet(path)
    written = files.sparkSession.read.schema("id string, split string, bucket string").parquet(path).groupBy("split", "bucket").agg(F.count("*").alias("copied"))
    gone = routes.join(files.select("id").distinct(), "id", "left_anti").groupBy("split", "bucket").agg(F.count("*").alias("missing"))
    out = materialize(written.join(gone, ["split", "bucket"], "full").fillna(0, ["copied", "missing"]), "export-report")
    release(routes, totals)
    return out
