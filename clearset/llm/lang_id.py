"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts are summed by Spark from a bounded sample of labelled rows; the matrix of
log-probabilities (buckets x languages) is broadcast, its size fixed by ``buckets`` and the
number of languages.  Scoring turns each batch of texts into one sparse document-by-bucket
index and multiplies it with the matrix in numpy.  Whole texts are used.

Defined cases: a text that is null or has no letter gets ``und`` with score 0; very long
texts are cut into pieces whose log-probabilities are added; without any labelled row
every text is ``und``; rows that repeat a doc_id are scored each on its own; an empty
table gives an empty result; extra columns stay, but columns named
lang_pred or lang_score give way to the operator's own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearset.llm.text import give_back, held_out, small_batches

UNKNOWN = "und"
NGRAMS = (1, 2, 3)
BUCKETS = 1 << 16
#: Expected number of labelled rows that are fitted (a sample by hash of the doc_id).
TRAIN_ROWS = 20_000
#: Characters that are turned into n-grams at once.
PIECE = 1 << 18


def ngram_index(texts: list[str], buckets: int = BUCKETS, starts: int | None = None) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sparse index of a few texts, for each n-gram size: (bucket ids, the text each belongs
    to), in order of the texts.  Letters count in lower case; n-grams do not cross texts.
    ``starts``: only n-grams that start before this character."""
    lowered = [t.lower() for t in texts]
    joined = np.frombuffer("\0".join([*lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    # the character behind each text belongs to none
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    owner = np.repeat(np.arange(len(lowered), dtype=np.int32), sizes + 1)
    owner[np.cumsum(sizes + 1) - 1] = -1
    ids, owners = [], []
    h = np.zeros(len(joined), np.uint32)
    for n in range(1, max(NGRAMS) + 1):
        h = h[: len(joined) - n + 1] * np.uint32(0x01000193) + joined[n - 1 :]
        if n in NGRAMS:
            mixed = (h + np.uint32(n)) * np.uint32(0x9E3779B1)
            inside = (owner[: len(h)] == owner[n - 1 :]) & (owner[n - 1 :] >= 0)
            inside[starts:] &= starts is None
            ids.append(((mixed ^ (mixed >> np.uint32(15))) % np.uint32(buckets))[inside])
            owners.append(owner[: len(h)][inside])
    return ids, owners


def pieces(texts: list[str], size: int = PIECE) -> Iterator[tuple[int, list[str], int | None]]:
    """(index of the first text, texts, starts) in runs of about ``size`` characters; a longer
    text comes in several runs that overlap by less than an n-gram."""
    first, run, n = 0, [], 0
    for i, t in enumerate(texts):
        if run and n + len(t) > size:
            yield first, run, None
            run, n = [], 0
        if not run:
            first = i
        if len(t) > size:
            for at in range(0, len(t), size):
                yield i, [t[at : at + size + max(NGRAMS) - 1]], size
            continue
        run.append(t)
        n += len(t)
    if run:
        yield first, run, None


def bucket_sums(texts: list[str], matrix: np.ndarray) -> np.ndarray:
    """Rows of the sparse product (texts x buckets) . matrix."""
    out = np.zeros((len(texts), matrix.shape[1]))
    for start, run, starts in pieces(texts):
        for i, o in zip(*ngram_index(run, len(matrix), starts)):
            if len(o):
                first = np.flatnonzero(np.r_[True, o[1:] != o[:-1]])
                out[start + o[first]] += np.add.reduceat(matrix[i], first, axis=0)
    return out


def train(docs: DataFrame, label: str = "lang", text: str = "text", doc_id: str = "doc_id", buckets: int = BUCKETS, max_rows: int = TRAIN_ROWS, smoothing: float = 0.1) -> tuple[list[str], np.ndarray]:
    """(languages, buckets x languages float32 log-probabilities plus log-prior as last row).

    Rows whose crc32(doc_id) mod 4 is 2, or whose label or text is null, are not used.
    """
    labelled = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull() & ~held_out(F.col(doc_id)))
    small_batches(docs.sparkSession)
    n = labelled.select(label).count()
    share = min(1.0, max_rows / max(n, 1))
    sample = labelled.where(F.pmod(F.xxhash64(F.lit("lang"), F.col(doc_id)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    sample = sample.select(F.col(label).alias("lang"), F.col(text).alias("text")).repartition(8)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for pdf in batches:
            for lang, part in pdf.groupby("lang", sort=False):
                total = sums.setdefault(lang, np.zeros(buckets, np.int64))
                rows[lang] = rows.get(lang, 0) + len(part)
                for _, run, starts in pieces(part["text"].tolist()):
                    for i in ngram_index(run, buckets, starts)[0]:
                        total += np.bincount(i, minlength=buckets)
        for lang, total in sums.items():
            at = np.flatnonzero(total)
            yield pd.DataFrame({"lang": lang, "bucket": at.astype(np.int32), "n": total[at]})
            yield pd.DataFrame({"lang": [lang], "bucket": np.array([-1], np.int32), "n": [rows[lang]]})

    counts = sample.mapInPandas(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counts.toPandas()  # at most (buckets + 1) rows a language
    langs = sorted(found["lang"].unique())
    table = np.zeros((buckets + 1, len(langs)))
    table[found["bucket"].to_numpy(), found["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(int)] = found["n"].to_numpy()
    prior, table = table[-1], table[:-1] + smoothing
    logs = np.vstack([np.log(table / table.sum(axis=0)), np.log(np.maximum(prior, 1) / max(prior.sum(), 1))]) if langs else np.zeros((buckets + 1, 0))
    return langs, logs.astype(np.float32)


def predict(docs: DataFrame, langs: list[str], logs: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` with (lang_pred, lang_score) added: the likeliest language and its posterior."""
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(logs)
    names = np.array([*langs, UNKNOWN], dtype=object)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        give_back()
        matrix, prior = model.value[:-1], model.value[-1]
        for column in batches:
            texts = [t if isinstance(t, str) else "" for t in column]
            best, p = np.full(len(texts), len(langs)), np.zeros(len(texts))
            lettered = np.fromiter((any(map(str.isalpha, t)) for t in texts), bool, len(texts))
            if langs and lettered.any():
                own = np.flatnonzero(lettered)
                sums = bucket_sums([texts[i] for i in own], matrix) + prior
                sums -= sums.max(axis=1, keepdims=True)
                best[own] = sums.argmax(axis=1)
                p[own] = 1 / np.exp(sums).sum(axis=1)
            yield pd.DataFrame({"lang": names[best], "score": p})
        give_back()

    scored = F.pandas_udf(score, "lang string, score double")(F.col(text))
    out = docs.withColumn("__lang", scored)
    return out.withColumn("lang_pred", F.col("__lang.lang")).withColumn("lang_score", F.col("__lang.score")).drop("__lang")


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    out = predict(docs.drop("lang"), *train(docs))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
