"""Importance resampling: draw documents whose n-grams look like those of a target set.

Each block of texts (an Arrow batch of a partition) becomes one sequence of word ids with a
suffix array over it.  Runs of its LCP array are the groups of equal n-grams: each run is hashed
once, whatever the number of its occurrences, and the bucket's id is scattered back to them.
Spark adds the bucket counts of all blocks; the table of gains has one number a bucket, so its
size is the parameter ``buckets``.  Scores are ranked by ranges, with no global window.

Defined cases: a null text has no words; a document without n-grams has weight 0; with fewer than
``min_words`` words a document is scored but never drawn; rows that repeat a doc_id are documents
of their own (ties between them go by a hash of the text); a null doc_id draws the noise of an
empty one and comes last among ties; an empty corpus or target counts 0 in every bucket; extra
columns of ``importance_scores`` stay, but columns named n_words, n_features, weight or score give
way to its own.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearset.llm.numbering import Numbers
from clearset.llm.text import row_key, small_batches
from clearset.operators import ranking
from clearset.storage import materialize, release

ORDER, BUCKETS, MIN_WORDS, PERCENT, SEED = 1, 10_000, 20, 10, 2024

#: Every byte that no word holds as a space, A-Z as a-z; bytes above 127 belong to words.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


def suffix_array(ids: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(sa, lcp): all positions in the order of their next ``depth`` words, and how many of these
    each shares with the position before it.  ``ends``: where the document of a position ends."""
    at = np.arange(len(ids))
    ranks = [ids.astype(np.int64)]
    for k in range(1, depth):
        following = np.full(len(ids), -1, np.int64)
        inside = at + k < ends
        following[inside] = ids[at[inside] + k]
        ranks.append(np.unique(ranks[-1] * (int(ids.max(initial=0)) + 2) + following + 1, return_inverse=True)[1])
    sa = np.argsort(ranks[-1], kind="stable")
    lcp = np.zeros(len(ids), np.int64)
    for k, r in enumerate(ranks):
        lcp[1:] += (r[sa[1:]] == r[sa[:-1]]) & (sa[1:] + k < ends[sa[1:]])
    return sa, lcp


class Block:
    """Word ids of a few texts with their suffix array."""

    def __init__(self, texts: list[str | None], order: int):
        number, ids, self.sizes = Numbers([]), [], []
        for t in texts:
            own = words_of(t)
            ids.append(np.fromiter(map(number.__getitem__, own), np.int32, len(own)))
            self.sizes.append(len(own))
        self.words, self.order = list(number), order
        self.ids = np.concatenate([np.zeros(0, np.int32), *ids])
        self.ends = np.repeat(np.cumsum(self.sizes), self.sizes)
        self.sa, self.lcp = suffix_array(self.ids, self.ends, order)

    def runs(self, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(positions, run of each position, bucket of each run) of all n-grams of ``n`` words."""
        whole = self.sa + n <= self.ends[self.sa]
        first = (self.lcp < n) & whole
        run = np.cumsum(first) - 1
        starts = self.sa[first]
        if n == 1:
            hashed = (zlib.crc32(self.words[i]) for i in self.ids[starts].tolist())
        else:
            hashed = (zlib.crc32(b" ".join([self.words[i] for i in self.ids[s : s + n].tolist()])) for s in starts.tolist())
        return self.sa[whole], run[whole], np.fromiter(hashed, np.int64, len(starts)) % buckets

    def bucket_counts(self, buckets: int) -> np.ndarray:
        total = np.zeros(buckets, np.int64)
        for n in range(1, self.order + 1):
            _, run, bucket = self.runs(n, buckets)
            np.add.at(total, bucket, np.bincount(run, minlength=len(bucket)))
        return total

    def sums(self, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(features, sum of their gains) of each text."""
        value, features = np.zeros(len(self.ids), np.int64), np.zeros(len(self.sizes), np.int64)
        sizes = np.array(self.sizes, np.int64)
        for n in range(1, self.order + 1):
            at, run, bucket = self.runs(n, len(gains))
            value[at] += gains[bucket[run]]
            features += np.maximum(sizes - n + 1, 0)
        total = np.r_[0, np.cumsum(value)]
        last = np.cumsum(sizes)
        return features, total[last] - total[last - sizes]


def bucket_counts(texts: DataFrame, order: int = ORDER, buckets: int = BUCKETS, text: str = "text") -> DataFrame:
    """(bucket, n): n-grams of 1 to ``order`` words of all texts, repeats counted; at most one row
    a bucket and partition is shuffled."""
    small_batches(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            total += Block(b.column(0).to_pylist(), order).bucket_counts(buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch({"bucket": some.astype(np.int32), "n": total[some]})

    return texts.select(text).mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 * log of target share over corpus share) of each bucket, with one added to each."""

    def counts(texts: DataFrame) -> list[int]:
        found = dict(bucket_counts(texts, order, buckets).collect())  # at most one row a bucket
        return [found.get(b, 0) for b in range(buckets)]

    s, t = counts(corpus), counts(target)
    all_s, all_t = sum(s) + buckets, sum(t) + buckets
    return np.array([math.floor(1000 * math.log(float((t[b] + 1) * all_s) / float((s[b] + 1) * all_t))) for b in range(buckets)], np.int64)


def importance_scores(docs: DataFrame, gain: np.ndarray, order: int = ORDER, seed: int = SEED) -> DataFrame:
    """``docs`` with n_words, n_features, weight (floored mean gain of its n-grams) and score (weight
    plus Gumbel noise of the doc_id, so that the highest scores are a sample without replacement)."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def weigh(texts: pa.Array) -> pa.Array:
        block = Block(texts.to_pylist(), order)
        n, total = block.sums(shared.value)
        return pa.StructArray.from_arrays([pa.array(block.sizes, pa.int64()), pa.array(n), pa.array(total // np.maximum(n, 1))], ["n_words", "n_features", "weight"])

    weighed = F.arrow_udf(weigh, "n_words long, n_features long, weight long")
    rest = [c for c in docs.columns if c not in ("n_words", "n_features", "weight", "score")]
    d = docs.select(*rest, weighed("text").alias("__w")).select(*rest, "__w.*")
    h = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    return d.withColumn("score", (F.col("weight") + noise).cast("long"))


def draw(scored: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """``scored`` (doc_id, rk, n_words, score and more) with rank: 1, 2, ... from the highest score
    for the ``percent`` of the rows with enough words that are drawn, else null."""
    able = scored.where(F.col("n_words") >= min_words)
    n = able.count() * percent // 100
    tie = F.struct(F.col("doc_id").isNull(), "doc_id", "rk")
    placed = ranking.position(able.withColumn("__tie", tie), "score", "__place", "__tie").drop("__tie")
    placed = placed.withColumn("rank", F.when(F.col("__place") <= n, F.col("__place"))).drop("__place")
    others = scored.where(~(F.col("n_words") >= min_words)).withColumn("rank", F.lit(None).cast("long"))
    return placed.select(*scored.columns, "rank").unionByName(others)


def op12_importance(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text")
    scored = importance_scores(docs.withColumn("rk", row_key(F.col("doc_id"), F.col("text"))), gains(docs, target)).drop("text")
    scored = materialize(scored, "importance-scores")
    out = materialize(draw(scored).select("doc_id", "n_features", "weight", "score", "rank"), "importance-ranks")
    release(scored)
    return out


#: The bytes' crc32 goes by a table of 256 numbers that SQL derives from the polynomial.
OP12_SQL = r"""
WITH tab AS (
  SELECT list(c ORDER BY b) AS tab FROM (
    SELECT b, list_reduce(list_concat([b], range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS b))),
w AS (
  SELECT 'd' AS kind, rowid AS r, doc_id, unnest(ws) AS word FROM (
    SELECT row_number() OVER () AS rowid, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents)
  UNION ALL
  SELECT 'b', NULL, NULL, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
v AS (
  SELECT word, xor(list_reduce(list_concat([4294967295], list_transform(range(length(hex(word)) // 2), lambda i: CAST('0x' || substr(hex(word), CAST(2 * i + 1 AS INT), 2) AS BIGINT))),
         lambda c, x: xor(c >> 8, tab[xor(c & 255, x) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM w), tab),
c AS (SELECT bucket, count(*) FILTER (kind = 'd') AS s, count(*) FILTER (kind = 'b') AS t FROM w JOIN v USING (word) GROUP BY bucket),
n AS (SELECT coalesce(sum(s), 0) AS ss, coalesce(sum(t), 0) AS tt FROM c),
g AS (SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) * (ss + 10000) AS DOUBLE) / CAST((s + 1) * (tt + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM c, n),
f AS (SELECT r, count(*) AS n_features, CAST(floor(sum(gain) / CAST(count(*) AS DOUBLE)) AS BIGINT) AS weight FROM w JOIN v USING (word) JOIN g USING (bucket) WHERE kind = 'd' GROUP BY r),
h AS (
  SELECT d.doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || d.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM (SELECT row_number() OVER () AS rowid, doc_id FROM documents) d LEFT JOIN f ON d.rowid = f.r)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * able // 100 AND n_features >= 20 THEN place END AS rank
FROM (SELECT *, count(*) FILTER (n_features >= 20) OVER () AS able, row_number() OVER (ORDER BY n_features >= 20 DESC, score DESC, doc_id) AS place FROM h)
"""
