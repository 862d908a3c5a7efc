"""Column helpers that the text operators share (JVM-side only), and the memory of Python workers."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: White space of the contracts: space and the code points 9 to 13.
SPACES = " \t\n\x0b\x0c\r"


#: Texts that go to a Python worker at once, so that a batch takes a few megabytes on either side.
BATCH_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Lower the rows of an Arrow batch to BATCH_ROWS, unless the session has set them."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


#: Bytes that a Python worker may hold free in a block, and glibc's names for the two bounds; without them
#: glibc raises both to the largest block that was freed.
KEPT, _M_TRIM_THRESHOLD, _M_MMAP_THRESHOLD = 4 << 20, -1, -3


def give_back() -> None:
    """Return to the system what this Python worker holds free.  Spark keeps workers from one task to the
    next, beside the executor's heap; called where a task begins and where it ends, this drops what it and
    those before it took.  Blocks of more than KEPT bytes go back as soon as they are freed."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):  # glibc only
        libc.mallopt(_M_TRIM_THRESHOLD, KEPT)
        libc.mallopt(_M_MMAP_THRESHOLD, KEPT)
        libc.malloc_trim(0)


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` is used for pure ASCII, where both agree and it is
    much cheaper than ``translate``."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def words_between_spaces(text: Column) -> Column:
    """Maximal runs of characters other than ``SPACES``; null gives an empty array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t-\r]+"), lambda w: w != "")


def word_ids(text: Column, buckets: int) -> Column:
    """Letter and digit runs of the lower-cased text, hashed to ``buckets`` ids."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))


def row_key(doc_id: Column, text: Column) -> Column:
    """Hash that keeps apart rows that repeat a doc_id with another text."""
    return F.xxhash64(doc_id, text)


def held_out(doc_id: Column) -> Column:
    """The rows that no model learns from: crc32 of the id as text, modulo 4, is 2."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2
