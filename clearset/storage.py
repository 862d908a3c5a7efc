"""Shared scratch storage: every intermediate that cuts lineage goes through here.

On a cluster the folder is the one named by ``spark.checkpoint.dir``; it has to be
visible to the driver and to all executors.  Only when the session names none (tests
in local mode) a folder of our own is set.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; set to a new one only where it is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(path)
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Spark's own switch for deleting the shuffle files of a query once it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def small_arrow(spark: SparkSession, size: int):
    """Arrow batches of about ``size`` bytes at most for what is written meanwhile."""
    return _setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lineage cut that survives
    the loss of executors, and a table whose size is known.  The shuffle files behind it are
    deleted as soon as it is written; ``release`` deletes the table itself."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with _setting(spark, _CLEANUP, "true"):
        df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing reads any more: all that was made of them
    has been written."""
    for table in tables:
        drop_path(table.sparkSession, table.scratch_path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there (through Hadoop's file system)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder below the shared one (through Hadoop's file system)."""
    if not path.startswith(shared_dir(spark)):
        raise ValueError(f"{path} is not below the shared folder")
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


#: Rows up to which a side of a join is broadcast, and bytes of its rows in memory: a wider or
#: larger side goes through a shuffle join instead.
BROADCAST_ROWS, BROADCAST_BYTES = 400_000, 32 << 20


def cell_bytes(value: Column, kind: T.DataType) -> Column:
    """Bytes that a value takes in a row: eight for a number, beside the length of what varies."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = 16 + F.octet_length(value)
    elif isinstance(kind, T.StructType):
        size = reduce(lambda a, b: a + b, [cell_bytes(value[f.name], f.dataType) for f in kind], F.lit(16))
    elif isinstance(kind, T.MapType):
        size = cell_bytes(F.map_entries(value), T.ArrayType(T.StructType().add("key", kind.keyType).add("value", kind.valueType)))
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StringType, T.BinaryType, T.StructType, T.MapType, T.ArrayType)):
        size = 16 + F.aggregate(F.transform(value, lambda x: cell_bytes(x, kind.elementType)), F.lit(0).cast("long"), lambda a, b: a + b)
    elif isinstance(kind, T.ArrayType):
        size = 16 + 8 * F.size(value)
    else:
        size = F.lit(8)
    return F.coalesce(size.cast("long"), F.lit(8).cast("long"))


def measured(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes of them in memory) of what ``df`` holds, whatever it was made from."""
    width = reduce(lambda a, b: a + b, [cell_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema], F.lit(16).cast("long"))
    rows, size = df.agg(F.count("*"), F.sum(width)).first()
    return rows, size or 0


def checked_broadcast(small: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint ``small`` as a broadcast side if its counted rows and their measured bytes stay within the
    bounds; otherwise return it as it is, so that the join shuffles on its key and adaptive execution
    can split skewed partitions.  ``small`` should read a written table: it is read for this."""
    rows, size = measured(small)
    return F.broadcast(small) if rows <= max_rows and size <= max_bytes else small.hint("merge")
