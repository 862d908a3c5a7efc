"""The corpus pipeline: five operators of the llm package, one after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's docs.  All but the last return the columns of docs.

Defined cases, for every stage: columns that docs has beyond those of documents stay, whatever
their names; a row is told apart by its doc_id and text, so rows that repeat a doc_id with another
text, or have none, are documents of their own; an empty table gives an empty result.  What
happens to null and blank texts and to repeated rows is said at each stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clearset.llm import decontamination, lang_id, line_dedup, ngram_join, sentencepiece_viterbi
from clearset.llm.text import SPACES, row_key
from clearset.storage import checked_broadcast, materialize, release

#: Names of our own beside the columns of docs.
ROW, KEY = "__pipeline_row", "__pipeline_key"


def apart(docs: DataFrame) -> DataFrame:
    """(ROW, doc_id, text): whole rows beside the columns that operators read, so that no column that
    an operator adds meets one of docs."""
    return docs.select(F.struct(*docs.columns).alias(ROW), "doc_id", "text")


def keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn(KEY, row_key(F.col("doc_id"), F.col("text")))


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id and key the table ``gone`` (__id, __key) has."""
    return keyed(docs).join(checked_broadcast(gone), same_row(), "left_anti").select(docs.columns)


def same_row() -> Column:
    return (F.col(KEY) == F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__id"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language cannot be told (null, or without a letter) go.  Where ``lang`` is
    null the predicted language takes its place.  Repeated rows are judged each."""
    model = lang_id.train(docs.select("doc_id", "text", "lang"))
    out = lang_id.predict(apart(docs), *model).where(F.col("lang_pred") != lang_id.UNKNOWN)
    return out.select(F.col(ROW).withField("lang", F.coalesce(f"{ROW}.lang", "lang_pred")).alias(ROW)).select(f"{ROW}.*")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of ten documents or more go, but one copy of the text of each group of copies
    stays.  Documents that become blank go: their lines are kept in another one.  Texts that lose
    nothing stay as they are, null and blank ones too; n_chars follows the text."""
    d = docs.select("doc_id", "text")
    all_lines = materialize(line_dedup.keep_bitmaps(d), "keep-bitmaps")
    bitmaps = materialize(line_dedup.spare_first_copies(d, all_lines), "spared-bitmaps")
    release(all_lines)
    out = line_dedup.apply_bitmaps(apart(docs), bitmaps)
    changed: Column = F.col("n_dropped") > 0
    out = out.where(~changed | (F.btrim("kept_text", F.lit(SPACES)) != ""))
    row = F.col(ROW).withField("text", F.when(changed, F.col("kept_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        row = row.withField("n_chars", F.when(changed, F.length("kept_text").cast(kind)).otherwise(F.col(f"{ROW}.n_chars")))
    return out.select(row.alias(ROW)).select(f"{ROW}.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays: the one with the smallest id and, among
    rows that repeat it, the smallest key; rows without an id come last.  Of rows that are equal
    in id and text the one with the smallest other columns stays.  Null and wordless texts are
    near duplicates of nothing and all stay."""
    found = ngram_join.near_duplicate_rows(docs.select("doc_id", "text")).where("component IS NOT NULL")
    found = materialize(found.groupBy("component", "doc_id", "rk").agg(F.count("*").alias("n")), "near-duplicates")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "rk")
    first = found.groupBy("component").agg(F.min(order).alias("first"))
    stays = (F.col("rk") == F.col("first.rk")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    named = materialize(found.join(first, "component").select(F.col("doc_id").alias("__id"), F.col("rk").alias("__key"), "n", stays.alias("stays")), "named-rows")
    release(found)
    gone = materialize(named.where("NOT stays OR n > 1").select("__id", "__key"), "gone-rows")
    equal = materialize(named.where("stays AND n > 1").select("__id", "__key"), "equal-rows")
    release(named)
    one = without(docs, gone)
    if equal.isEmpty():
        return one
    rows = keyed(docs).join(checked_broadcast(equal), same_row(), "left_semi")
    return one.unionByName(rows.groupBy(KEY).agg(F.min(F.struct(*docs.columns)).alias(ROW)).select(f"{ROW}.*"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a window of words with the benchmark go, with all rows that repeat
    them.  Null and wordless texts stay."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    _, found = decontamination.counted_and_found(docs.select("doc_id", "text"), items)
    return without(docs, materialize(found.select(F.col("doc").alias("__id"), F.col("rk").alias("__key")), "contaminated-rows"))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of what is left, the model's own, found by the streaming search over pairs of pieces, with a
    check that they decode to the text.  A null or empty text has none; repeated rows are encoded each."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = sentencepiece_viterbi.encode(docs.select("doc_id", "lang", "source", "text"), path, search="pairs")
    return coded.select("doc_id", "lang", "source", "piece_ids", F.size("piece_ids").cast("long").alias("n_pieces"), "round_trip")


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]

#: Naive Bayes and the Viterbi search have no SQL form; the tests hold run() against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``.  A stage's table goes once the next one is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
        if before is not None:
            release(before)
        before = docs
    return docs
