"""Benchmark decontamination by winnowing (DataFrame functions only).

Texts become word hashes and hashes of ``GRAM`` consecutive words; of each window, that is of
``window - GRAM + 1`` such hashes, the smallest is its fingerprint.  Both sides choose alike, so
every window of ``window`` words that they share has the same one: joining the fingerprints of
all document windows with those of the benchmark leaves the places where a shared window can
begin.  Only there texts are read again: the hit is extended to its whole window, which is joined
with the benchmark's on 128-bit hashes, and windows that touch or overlap become one span.
Items of fewer words than a window are one window each, whose fingerprint is that of all words;
documents are fingerprinted for just those lengths as well.

Consecutive windows mostly choose the same hash: they are one row of the join, which only rows that
meet a fingerprint of the benchmark leave.  Words are counted apart from it.  Fingerprints of the
benchmark are broadcast only behind a check of their size; both joins otherwise shuffle on the
fingerprint.

Defined cases: a null text, or one without words, has no words and no hits; ties between
equal hashes do not matter, as a fingerprint is a value; rows that repeat a doc_id with the
same text share one result, rows that repeat it with another text have their own, and so have
rows without an id; items that repeat an id count once; an empty table gives an empty result,
an empty benchmark no hits; extra columns are ignored by ``scan`` and kept by ``decontaminate``,
where columns named n_words, n_hit or items give way to its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearset.llm.text import lower_ascii, row_key
from clearset.storage import checked_broadcast, materialize, release

#: Words of a window, and of the grams that fingerprints are chosen from.
WINDOW, GRAM = 10, 5


def benchmark_words(text: Column) -> Column:
    """Runs of digits, a-z (A-Z lower-cased) and characters beyond ASCII."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.filter(parts, lambda w: w != "")


def gram_hashes(hashes: str, n: int) -> Column:
    """Hashes of all ``n`` consecutive entries of an array column; empty if it is shorter."""
    h = F.col(hashes)
    if n == 1:
        return h
    at = F.sequence(F.lit(1), F.size(h) - (n - 1))
    return F.when(F.size(h) >= n, F.transform(at, lambda i: F.xxhash64(F.lit(n), *[F.element_at(h, i + j) for j in range(n)]))).otherwise(F.array().cast("array<bigint>"))


def fingerprints(rows: DataFrame, text: str, keys: list[str], window: int = WINDOW, lengths: tuple[int, ...] = (), gram: int = GRAM) -> DataFrame:
    """(keys, n, pos, run, fp): the fingerprint of the windows of ``window`` words, or of one of the
    short ``lengths``, by their size n and the first word of the first of them.  Windows in a row
    that choose the same hash are one row: ``run`` says how many."""
    size = window - gram + 1
    # each array is used several times, so that the optimizer keeps it in a projection of its own
    d = rows.select(*keys, benchmark_words(F.col(text)).alias("__w"))
    d = d.select(*keys, F.transform("__w", lambda w: F.xxhash64(w)).alias("__h"))
    d = d.select(*keys, "__h", gram_hashes("__h", gram).alias("__g"))
    none = F.array().cast("array<bigint>")
    chosen = F.when(F.size("__g") >= size, F.transform(F.sequence(F.lit(1), F.size("__g") - (size - 1)), lambda i: F.array_min(F.slice("__g", i, size)))).otherwise(none)
    d = d.select(*keys, "__h", chosen.alias("__c"))
    new = F.filter(F.transform("__c", lambda _, i: i), lambda i: (i == 0) | (F.get("__c", i) != F.get("__c", i - 1)))
    d = d.select(*keys, "__h", "__c", new.alias("__s"))

    def place(n: int, i: Column, run: Column, fp: Column) -> Column:
        return F.struct(F.lit(n).alias("n"), (i + 1).alias("pos"), run.alias("run"), fp.alias("fp"))

    def short(n: int) -> Column:
        return F.transform(gram_hashes("__h", n), lambda h, i: place(n, i, F.lit(1), h))

    long = F.transform("__s", lambda i, k: place(window, i, F.coalesce(F.get("__s", k + 1), F.size("__c")) - i, F.get("__c", i)))
    return d.select(*keys, F.explode(F.concat(long, *map(short, lengths))).alias("__f")).select(*keys, "__f.*")


def windows(rows: DataFrame, text: str, keys: list[str], places: Column) -> DataFrame:
    """(keys, n, pos, w1, w2) of the windows of each text at ``places``, an array of (n, pos)."""
    d = rows.select(*keys, places.alias("__p"), benchmark_words(F.col(text)).alias("__w"))
    text_of = lambda p: F.array_join(F.slice(F.col("__w"), p["pos"], p["n"]), " ")
    d = d.select(*keys, F.explode(F.transform("__p", lambda p: F.struct(p["n"].alias("n"), p["pos"].alias("pos"), text_of(p).alias("t")))).alias("w"))
    return d.select(*keys, "w.n", "w.pos", F.xxhash64("w.t").alias("w1"), F.xxhash64(F.lit(7), F.col("w.t")).alias("w2"))


def all_places(n: Column, size: Column) -> Column:
    """The windows of ``size`` of a text of ``n`` words."""
    return F.transform(F.sequence(F.lit(1), n - size + 1), lambda i: F.struct(size.alias("n"), i.alias("pos")))


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return (a["rk"] == b["rk"]) & a["doc"].eqNullSafe(b["doc"])


def counted_and_found(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(counted, found): (doc, rk, n_words) of each row of ``docs``, and (doc, rk, n_hit, items) once
    for each contaminated text; ``items``: sorted ids, as strings, of the items that have a window
    in the text, read from a table in the shared folder."""
    d = docs.select(F.col("doc_id").alias("doc"), row_key(F.col("doc_id"), F.col("text")).alias("rk"), "text")
    b = items.select("item_id", "text", F.size(benchmark_words(F.col("text"))).alias("__words")).where("__words > 0")
    b = b.withColumn("__n", F.least("__words", F.lit(window)))
    # at most ``window`` numbers
    lengths = tuple(sorted(r[0] for r in b.select("__n").distinct().collect() if r[0] < window))

    fps = materialize(fingerprints(b, "text", ["__n"], window, lengths).where("n = __n").select("n", "fp").distinct(), "item-fingerprints")
    marked = fingerprints(d, "text", ["doc", "rk"], window, lengths).join(checked_broadcast(fps), ["n", "fp"], "left_semi")
    marked = marked.select("doc", "rk", "n", F.explode(F.sequence("pos", F.col("pos") + F.col("run") - 1)).alias("pos"))
    places = marked.groupBy("doc", "rk").agg(F.collect_set(F.struct("n", "pos")).alias("places"))
    places = materialize(places, "places-of-texts")
    release(fps)
    p = checked_broadcast(places)
    closer = d.join(p, same_row(d, p)).select(d["doc"], d["rk"], "text", "places").dropDuplicates(["doc", "rk"])
    own = windows(closer, "text", ["doc", "rk"], F.col("places"))
    wanted = windows(b, "text", ["item_id"], all_places(F.col("__words"), F.col("__n")))
    wanted = materialize(wanted.select("item_id", "n", "w1", "w2").distinct(), "item-windows")
    known = materialize(wanted.select("n", "w1", "w2").distinct(), "known-windows")
    hits = materialize(own.join(checked_broadcast(known), ["n", "w1", "w2"], "left_semi"), "window-hits")
    pairs = hits.select("doc", "rk", "n", "w1", "w2").distinct().join(checked_broadcast(wanted), ["n", "w1", "w2"])
    named = pairs.groupBy("doc", "rk").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    by_text = hits.groupBy("doc", "rk").agg(covered(F.collect_list(F.struct("pos", "n"))).alias("n_hit"))
    found = by_text.join(named, same_row(by_text, named)).select(by_text["doc"], by_text["rk"], "n_hit", "items")
    found = materialize(found, "contaminated")
    release(places, wanted, known, hits)
    return d.select("doc", "rk", F.size(benchmark_words(F.col("text"))).alias("n_words")), found


def covered(hits: Column) -> Column:
    """Words in the union of spans (pos, n)."""
    start = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).alias("reach"))

    def add(a: Column, x: Column) -> Column:
        end = x["pos"] + x["n"]
        new = F.greatest(F.lit(0), end - F.greatest(a["reach"], x["pos"]))
        return F.struct((a["words"] + new).alias("words"), F.greatest(a["reach"], end).alias("reach"))

    return F.aggregate(F.sort_array(hits), start, add, lambda a: a["words"])


def _with_hits(rows: DataFrame, found: DataFrame, doc: Column, rk: Column) -> DataFrame:
    """``rows`` with (n_hit, items) of their texts added."""
    f = checked_broadcast(found.select(F.col("doc").alias("__doc"), F.col("rk").alias("__rk"), F.col("n_hit").alias("__hit"), F.col("items").alias("__items")))
    out = rows.join(f, (rk == F.col("__rk")) & doc.eqNullSafe(F.col("__doc")), "left")
    out = out.withColumn("n_hit", F.coalesce("__hit", F.lit(0)).cast("long")).withColumn("items", F.coalesce("__items", F.array().cast("array<string>")))
    return out.drop("__doc", "__rk", "__hit", "__items")


def scan(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, rk, n_words, n_hit, items) of each row of ``docs`` (doc_id, text): its words, those in
    windows that an item has, and the sorted ids, as strings, of these items."""
    counted, found = counted_and_found(docs, items, window)
    rows = counted.select(F.col("doc").alias("doc_id"), "rk", F.col("n_words").cast("long").alias("n_words"))
    return _with_hits(rows, found, F.col("doc_id"), F.col("rk"))


def decontaminate(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the (n_words, n_hit, items) of ``scan`` added."""
    _, found = counted_and_found(docs, items, window)
    out = docs.withColumn("n_words", F.size(benchmark_words(F.col("text"))).cast("long"))
    return _with_hits(out, found, F.col("doc_id"), row_key(F.col("doc_id"), F.col("text")))


def op8_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return scan(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


OP8_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS t
       FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM bs)),
k AS (SELECT DISTINCT n, t FROM bw),
dw AS (SELECT r, n, p, array_to_string(w[p:p + n - 1], ' ') AS t
       FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM bs) WHERE len(w) >= n)),
h AS (SELECT r, dw.n, p, t FROM dw JOIN k USING (n, t)),
c AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM h) GROUP BY r),
i AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM h JOIN bw USING (n, t)) GROUP BY r)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN i USING (r)
"""
