"""Line deduplication over a whole corpus (DataFrame functions only).

Line hashes are range-partitioned by (hash, document) with a secondary sort by position.
As the document is part of the range, a line that a third of the corpus holds is spread
over many partitions; each streams its first occurrences per document and pre-aggregates
them, so one row per hash and partition is what the counting shuffles.  The result is
not text but, per document, a compressed bitmap of the lines that stay.

Defined cases: a null or empty text is one empty line; lines whose key is shorter than
``min_chars`` are never dropped; a document is a doc_id: rows that repeat one count once for
the frequency of a line, whatever their texts, and rows without an id do not count, but all of
them lose frequent lines; rows that repeat a doc_id with the same text share one bitmap; an empty
table gives an empty result; extra columns are ignored and kept by ``apply_bitmaps``,
where columns named n_lines, n_dropped or kept_text give way to its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clearset.llm.text import SPACES, lower_ascii, row_key
from clearset.storage import checked_broadcast, materialize, release


def line_key(line: Column) -> Column:
    """The line without white space at both ends and with A-Z lower-cased."""
    return F.btrim(lower_ascii(line), F.lit(SPACES))


def line_hashes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", min_chars: int = 1) -> DataFrame:
    """One row (h1, h2, doc, rk, pos) per line whose key has ``min_chars`` code points or more."""
    lines = F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)

    def hashed(line: Column, pos: Column) -> Column:
        key = line_key(line)
        # two chained 64-bit hashes: the second one is seeded by the first
        return F.when(
            F.length(key) >= min_chars,
            F.struct(pos.alias("pos"), F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(7), key).alias("h2")),
        )

    rows = docs.select(
        F.col(doc_id).alias("doc"),
        row_key(F.col(doc_id), F.col(text)).alias("rk"),
        F.explode(F.transform(lines, hashed)).alias("l"),
    )
    return rows.where(F.col("l").isNotNull()).select("l.h1", "l.h2", "doc", "rk", "l.pos")


def dropped_lines(lines: DataFrame, mode: str = "frequent", min_docs: int = 10) -> DataFrame:
    """Rows (doc, rk, pos) of the lines that go.

    ``frequent``: all lines whose key is found in ``min_docs`` documents or more.
    ``first``: all but the first line, by document and position, of each key.
    """
    by_doc = ["h1", "h2", "doc", "rk"]
    in_doc = Window.partitionBy(*by_doc).orderBy("pos")
    # (hash, document) ranges with a secondary sort by position: the window needs no other exchange
    lines = materialize(lines, "all-lines")  # ranges are found by a pass over the hashes alone
    ranged = lines.repartitionByRange(*by_doc).withColumn("nth", F.row_number().over(in_doc))
    ranged = materialize(ranged, "line-hashes")
    release(lines)
    if mode == "frequent":
        # rows are documents or more of them: few keys need their ids told apart
        rows = ranged.where("nth = 1 AND doc IS NOT NULL").groupBy("h1", "h2").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs)
        rows = materialize(rows.select("h1", "h2"), "lines-of-many-rows")
        ids = ranged.where("nth = 1 AND doc IS NOT NULL").join(checked_broadcast(rows), ["h1", "h2"], "left_semi").select("h1", "h2", "doc").distinct()
        keys = ids.groupBy("h1", "h2").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs)
        keys = materialize(keys.select("h1", "h2"), "frequent-lines")
        release(rows)
        return ranged.join(checked_broadcast(keys), ["h1", "h2"], "left_semi").select("doc", "rk", "pos")
    if mode == "first":
        at = F.struct("doc", "rk", "pos")
        keys = ranged.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(at).alias("first")).where("n > 1").drop("n")
        found = ranged.join(checked_broadcast(materialize(keys, "repeated-lines")), ["h1", "h2"])
        return found.where(~at.eqNullSafe(F.col("first"))).select("doc", "rk", "pos")
    raise ValueError(f"mode {mode!r} is neither 'frequent' nor 'first'")


def keep_bitmaps(
    docs: DataFrame, mode: str = "frequent", min_docs: int = 10, min_chars: int = 1, text: str = "text", doc_id: str = "doc_id"
) -> DataFrame:
    """Compressed keep bitmaps: (doc, rk, n_dropped, keep) for each document that loses a line.

    ``keep`` lists (word, bits): bit i of word w tells whether line 64 w + i stays.  Words
    without a dropped line, and documents that lose nothing, are left out (all ones).
    """
    return bitmaps_of(dropped_lines(line_hashes(docs, text, doc_id, min_chars), mode, min_docs))


def bitmaps_of(gone: DataFrame) -> DataFrame:
    """(doc, rk, n_dropped, keep) from the dropped lines (doc, rk, pos)."""
    gone = gone.select("doc", "rk", "pos").distinct()
    word = F.floor(F.col("pos") / 64).cast("int").alias("word")
    bit = F.expr("shiftleft(1L, pos % 64)")
    words = gone.groupBy("doc", "rk", word).agg(F.bit_or(bit).alias("gone"), F.count("*").alias("n"))
    return words.groupBy("doc", "rk").agg(
        F.sum("n").alias("n_dropped"),
        F.sort_array(F.collect_list(F.struct(F.col("word"), F.bitwise_not("gone").alias("bits")))).alias("keep"),
    )


def spare_first_copies(docs: DataFrame, bitmaps: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``bitmaps`` under which copies keep their text once.

    Documents that lose all or more than half of their characters are taken for copies, not for
    texts with boilerplate in them.  Of each line that goes from such documents, the first of
    them (by document) keeps it; the others, and all other documents, lose what they lost.
    """
    blank = F.btrim("kept_text", F.lit(SPACES)) == ""
    applied = apply_bitmaps(docs, bitmaps, text, doc_id).where((F.col("n_dropped") > 0) & (blank | (2 * F.length("kept_text") < F.length(text))))
    copies = materialize(applied.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).distinct(), "copies")
    own = copies.select(F.col("doc_id").alias("doc"), row_key(F.col("doc_id"), F.col("text")).alias("rk"))
    same = lambda a, b: (a["rk"] == b["rk"]) & a["doc"].eqNullSafe(b["doc"])
    own = checked_broadcast(materialize(own, "copy-keys"))
    theirs = materialize(bitmaps.join(own, same(bitmaps, own), "left_semi"), "copy-bitmaps")
    marks = theirs.select("doc", "rk", "keep")
    lines = line_hashes(copies)
    lost = lines.join(marks, same(lines, marks)).select("h1", "h2", lines["doc"], lines["rk"], "pos", F.map_from_entries("keep").alias("keep"))
    bits = F.coalesce(F.col("keep")[F.floor(F.col("pos") / 64).cast("int")], F.lit(-1).cast("long"))
    lost = materialize(lost.where(F.getbit(bits, F.col("pos") % 64) == 0).drop("keep"), "lines-of-copies")
    at = F.struct("doc", "rk")
    first = materialize(lost.groupBy("h1", "h2").agg(F.min(at).alias("first")), "first-copies")
    again = lost.join(checked_broadcast(first), ["h1", "h2"]).where(~at.eqNullSafe(F.col("first")))
    return bitmaps.join(own, same(bitmaps, own), "left_anti").unionByName(bitmaps_of(again))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with (n_lines, n_dropped, kept_text) added.  Texts are shuffled only where the
    bitmaps are too many to broadcast."""
    own = bitmaps.select(F.col("doc").alias("__doc"), F.col("rk").alias("__rk"), F.col("n_dropped").alias("__n"), F.col("keep").alias("__keep"))
    d = docs.withColumn("__own_rk", row_key(F.col(doc_id), F.col(text)))
    d = d.join(checked_broadcast(own), (F.col("__own_rk") == F.col("__rk")) & F.col(doc_id).eqNullSafe(F.col("__doc")), "left")
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.split(whole, "\n", -1)
    bits = F.map_from_entries("__keep")
    stays = F.filter(lines, lambda _, i: F.getbit(F.coalesce(bits[F.floor(i / 64).cast("int")], F.lit(-1).cast("long")), i % 64) == 1)
    return (
        d.withColumn("n_lines", F.size(lines).cast("long"))
        .withColumn("n_dropped", F.coalesce("__n", F.lit(0)).cast("long"))
        .withColumn("kept_text", F.when(F.col("__keep").isNull(), whole).otherwise(F.array_join(stays, "\n")))
        .drop("__own_rk", "__doc", "__rk", "__n", "__keep")
    )


def op5_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    bitmaps = materialize(keep_bitmaps(docs), "keep-bitmaps")
    out = apply_bitmaps(docs, bitmaps)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH l AS (
  SELECT d.rowid AS r, d.doc_id, u.i, u.line,
         translate(trim(u.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT row_number() OVER () AS rowid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents) d,
       LATERAL (SELECT unnest(d.ls) AS line, generate_subscripts(d.ls, 1) AS i) u),
f AS (SELECT k FROM l WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT any_value(l.doc_id) AS doc_id, count(*) AS n_lines, count(f.k) AS n_dropped,
       sha256(coalesce(string_agg(CASE WHEN f.k IS NULL THEN l.line END, chr(10) ORDER BY l.i), '')) AS kept_sha256
FROM l LEFT JOIN f ON l.k = f.k GROUP BY l.r
"""
