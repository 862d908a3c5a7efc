"""Importance resampling against plain Python, for one and for three words."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from clearset.llm import importance
from clearset.llm.text import row_key

TEXTS = [None, "", "!!! ...", "One two THREE one two three", "a", "été Été x" * 3, "same words here " * 9, "same words here " * 9, "w " * 4000 + "tail", "b c d e f g h i j k l m n o p q r s t u v"]
ROWS = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "another text under a repeated id " * 4), (None, "no id " * 30)]


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lowered)


def grams(text, order):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)]


def bucket(gram, buckets):
    return zlib.crc32(gram.encode()) % buckets


@pytest.mark.parametrize("order,buckets", [(1, 10_000), (3, 97)])
def test_scores_equal_plain_counts(spark, order, buckets):
    docs = spark.createDataFrame([(i, t, "kept", 7) for i, t in ROWS], "doc_id long, text string, extra string, weight int").repartition(3)
    target = spark.createDataFrame([("one two three",), ("same words",), (None,)], "text string")
    gain = importance.gains(docs, target, order, buckets)
    s = Counter(bucket(g, buckets) for _, t in ROWS for g in grams(t, order))
    t = Counter(bucket(g, buckets) for x in ("one two three", "same words") for g in grams(x, order))
    want = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]
    assert gain.tolist() == want
    got = importance.importance_scores(docs, gain, order)
    assert got.columns == ["doc_id", "text", "extra", "n_words", "n_features", "weight", "score"]
    for r in got.collect():
        own = grams(r.text, order)
        weight = sum(want[bucket(g, buckets)] for g in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"2024:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        assert (r.n_words, r.n_features, r.weight, r.score, r.extra) == (len(words(r.text)), len(own), weight, weight + noise, "kept")


def test_suffix_array_groups_equal_grams():
    block = importance.Block(["a b a b a", None, "b a", "a"], 3)
    at = {n: block.runs(n, 1 << 20) for n in (1, 2, 3)}
    seq = [[block.words[i] for i in block.ids[p : min(p + 3, block.ends[p])]] for p in block.sa]
    assert [len(at[n][2]) for n in (1, 2, 3)] == [2, 2, 2] and len(block.ids) == 8
    assert len({tuple(x) for x in seq}) == len({tuple(x) for i, x in enumerate(seq) if not i or seq[i - 1] != x})
    assert block.bucket_counts(1 << 20).sum() == 8 + 5 + 3


def test_draw_takes_the_highest_scores_with_ties_by_id(spark):
    rows = [(i, i, 20 if i % 3 else 19, i % 7) for i in range(100)] + [(4, 200, 25, 6), (None, 1, 25, 6)]
    scored = spark.createDataFrame(rows, "doc_id long, rk long, n_words long, score long").repartition(5)
    got = importance.draw(scored, 25).toPandas()
    able = sorted((r for r in rows if r[2] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = got[got["rank"].notna()].sort_values("rank")
    assert drawn["rank"].tolist() == list(range(1, len(able) * 25 // 100 + 1)) and len(got) == len(rows)
    assert drawn["rk"].tolist() == [r[1] for r in able[: len(drawn)]]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    gain = importance.gains(none, none.select("text"), buckets=11)
    assert gain.tolist() == [0] * 11
    scored = importance.importance_scores(none, gain).withColumn("rk", row_key(F.col("doc_id"), F.col("text")))
    assert importance.draw(scored).count() == 0


def test_block_handles_a_long_text_like_short_ones():
    long = " ".join(f"w{i % 977}" for i in range(200_000))
    block = importance.Block([long, "w1 w2"], 2)
    n, total = block.sums(np.ones(64, np.int64))
    assert n.tolist() == total.tolist() == [200_000 + 199_999, 3]
