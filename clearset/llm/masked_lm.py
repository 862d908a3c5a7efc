"""Masked pseudo-likelihood of documents under a bidirectional window network (numpy).

Words are hashed to SIDE * SIDE classes.  The network sees two words on either side of a
place: position-wise embeddings add up to a hidden vector, which predicts the high half of
the class and, given that half, the low one; so every conditional probability is exact
over all classes at the cost of two short softmax layers.  A document's score is the sum of
the conditional log-probabilities of all its words, each masked in turn.

A class holds many words.  The probability of a word is that of its class times the word's
share of the class's occurrences, for which all different words of the corpus are counted in a
table (words are told apart by 64 bits); each class keeps one occurrence for words that the
table does not hold.  The commonest FREQUENT words are broadcast; the others are summed by a join.

Training starts from the frequencies of the classes (as biases) and reads the whole corpus once,
in ROUNDS: in each round every worker takes a share of the texts, dealt evenly, runs stochastic
gradient descent over it from the model of the round before, and returns its parameters, row by
row, with the number of words that moved each row; Spark averages the rows by that weight.  The
number of workers follows from the number of words alone, so the model depends neither on how
the table is partitioned nor on the size of the cluster, but for the dealing of texts.  What is
gathered grows with the input, what reaches the driver is one model of fixed size a round.

Defined cases: a null text, or one without words, scores 0 with 0 words; long texts are
read whole, in pieces that overlap by the window; rows that repeat a doc_id train and score
each; an empty table leaves the starting model and gives an empty result; extra columns stay, but
columns named n_words, log_prob or word_log_prob give way to the operator's own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearset.llm.shingles import PIECE, word_hashes
from clearset.llm.text import small_batches
from clearset.storage import materialize, release

SIDE, HIDDEN = 64, 16
CLASSES = SIDE * SIDE
PAD = CLASSES
#: Places of the window, relative to the masked word.
WINDOW = (-2, -1, 1, 2)
REACH = max(map(abs, WINDOW))
BATCH, RATE = 2048, 0.08
#: Rounds of averaging; words that a worker trains on, and the workers that small corpora are
#: dealt to, if each gets FEW_WORDS.
ROUNDS, WORKER_WORDS, FEW_WORKERS, FEW_WORDS = 4, 1 << 21, 8, 1 << 18
#: Words that are broadcast with their counts, at most; words that are counted at once in a task.
FREQUENT, COUNTED = 1 << 20, 1 << 22
_PARTS = ("embed", "high", "low", "given", "high_bias", "low_bias")


def start(totals: np.ndarray | None = None, seed: int = 5) -> dict[str, np.ndarray]:
    """The model that knows how often each class occurs, and nothing of contexts."""
    rng = np.random.default_rng(seed)
    f = lambda *s: rng.normal(0, 0.1, s).astype(np.float32)
    by_high = (np.ones(CLASSES) if totals is None else totals).reshape(SIDE, SIDE)
    high = by_high.sum(axis=1, keepdims=True)
    return {
        "embed": f(len(WINDOW) * (CLASSES + 1), HIDDEN),
        "high": f(SIDE, HIDDEN),
        "low": f(SIDE, HIDDEN),
        "given": f(SIDE, HIDDEN),
        "high_bias": np.log(high / high.sum()).astype(np.float32),
        "low_bias": np.log(by_high / high).astype(np.float32),
    }


def contexts(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of the embedding table for each masked place: one column a window position."""
    return np.stack([ids[at + w] + k * (CLASSES + 1) for k, w in enumerate(WINDOW)])


def _odds(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials and their sums; weights stay far inside the bounds."""
    np.exp(np.clip(z, -60, 60, out=z), out=z)
    return z, z.sum(axis=1)


def forward(m: dict[str, np.ndarray], rows: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    h = m["embed"].take(rows[0], axis=0)
    for r in rows[1:]:
        h += m["embed"].take(r, axis=0)
    np.tanh(h, out=h)
    z = h @ m["high"].T
    z += m["high_bias"].T
    h2 = h + m["given"].take(high, axis=0)
    z2 = h2 @ m["low"].T
    z2 += m["low_bias"].take(high, axis=0)
    return h, h2, *_odds(z), *_odds(z2)


def log_probs(m: dict[str, np.ndarray], ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log-probability of the word at each place given its neighbours."""
    out = np.empty(len(at), np.float64)
    for a in range(0, len(at), BATCH):
        own = at[a : a + BATCH]
        high, low = ids[own] // SIDE, ids[own] % SIDE
        _, _, first, sum1, second, sum2 = forward(m, contexts(ids, own), high)
        i = np.arange(len(own))
        out[a : a + BATCH] = np.log(first[i, high].astype(np.float64) / sum1) + np.log(second[i, low].astype(np.float64) / sum2)
    return out


def step(m: dict[str, np.ndarray], moved: dict[str, np.ndarray], ids: np.ndarray, at: np.ndarray, rate: float = RATE) -> None:
    """One step of gradient descent over the places ``at``."""
    high, low = ids[at] // SIDE, ids[at] % SIDE
    rows = contexts(ids, at)
    h, h2, d1, sum1, d2, sum2 = forward(m, rows, high)
    i = np.arange(len(at))
    d1 /= sum1[:, None]
    d2 /= sum2[:, None]
    d1[i, high] -= 1
    d2[i, low] -= 1
    back2 = d2 @ m["low"]
    back = (d1 @ m["high"] + back2) * (1 - h * h)
    scale = rate * 30 / len(at)
    m["high"] -= scale * (d1.T @ h)
    m["low"] -= scale * (d2.T @ h2)
    m["high_bias"] -= scale * d1.sum(axis=0)[:, None]
    # each row moves by the sum of its gradients over the root of their number
    own = np.zeros((SIDE, len(at)), np.float32)
    own[high, i] = 1
    n = np.bincount(high, minlength=SIDE).astype(np.float32)
    pace = (rate / np.sqrt(np.maximum(n, 1)))[:, None]
    m["given"] -= pace * (own @ back2)
    m["low_bias"] -= pace * (own @ d2)
    for name in ("given", "low_bias"):
        moved[name] += n.astype(np.int64)
    flat = rows.ravel()
    seen = np.zeros(len(m["embed"]), bool)
    seen[flat] = True
    live, place = np.flatnonzero(seen), (np.cumsum(seen) - 1)[flat]  # the different rows, and which of them each place has
    n = np.bincount(place)
    # one sum a column, in doubles, over the places of all window positions
    total = np.stack([np.bincount(place, weights) for weights in np.tile(back.T.astype(np.float64), len(WINDOW))])
    total *= rate / np.sqrt(n)
    embed = m["embed"].take(live, axis=0)
    embed -= total.T.astype(np.float32)
    m["embed"][live] = embed
    moved["embed"][live] += n
    for name in ("high", "low", "high_bias"):
        moved[name] += len(at)


def hashed_words(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes of the words, words of each text) of pieces of a string column."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PIECE, "right")) - 1)
        own = offsets[first : last + 1]
        with np.errstate(over="ignore"):
            yield word_hashes(data[own[0] : own[-1]], own - own[0])
        first = last


def classes_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(CLASSES)).astype(np.int32)


def word_classes(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(classes, words of each text) of pieces of a string column."""
    for hashes, counts in hashed_words(column):
        yield classes_of(hashes), counts


def padded(classes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids with pads around each text, places of the words)."""
    gap = np.repeat(np.arange(len(counts)), counts) * REACH
    at = np.arange(len(classes)) + gap + REACH
    ids = np.full(len(classes) + (len(counts) + 1) * REACH, PAD, np.int32)
    ids[at] = classes
    return ids, at


def class_totals(words: DataFrame) -> np.ndarray:
    """Occurrences of each class, and one more for words that the table does not hold."""
    totals = np.ones(CLASSES)
    for r in words.groupBy(F.col("word").bitwiseAND(CLASSES - 1).alias("c")).agg(F.sum("n").alias("n")).collect():
        totals[r["c"]] += r["n"]
    return totals


def _strips(values: np.ndarray) -> np.ndarray:
    """Rows of a part of the model as rows of HIDDEN values."""
    width = -(-values.shape[1] // HIDDEN) * HIDDEN
    wide = np.zeros((len(values), width), np.float32)
    wide[:, : values.shape[1]] = values
    return wide.reshape(-1, HIDDEN)


def train(docs: DataFrame, text: str = "text", words: DataFrame | None = None, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """The model after one pass over all words; ``words``: the table (word, n) of ``vocabulary``."""
    spark = docs.sparkSession
    small_batches(spark)
    counted = words if words is not None else materialize(vocabulary(docs, text), "word-counts")
    totals = class_totals(counted)
    if words is None:
        release(counted)
    n_words = int(totals.sum()) - CLASSES
    workers = max(1, -(-n_words // WORKER_WORDS), min(FEW_WORKERS, -(-n_words // FEW_WORDS)))
    m = start(totals)
    values = [f"w{j}" for j in range(HIDDEN)]

    def round_of(shared: Broadcast) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = {k: v.copy() for k, v in shared.value.items()}
            moved = {k: np.zeros(len(v), np.int64) for k, v in m.items()}
            rng = np.random.default_rng(3)
            for batch in batches:
                for classes, counts in word_classes(batch.column(0)):
                    ids, at = padded(classes, counts)
                    at = rng.permutation(at)
                    for a in range(0, len(at), BATCH):
                        step(m, moved, ids, at[a : a + BATCH])
            for k, name in enumerate(_PARTS):
                strips = _strips(m[name])
                n = np.repeat(moved[name], len(strips) // len(m[name]))
                live = np.flatnonzero(n)
                if len(live):
                    sums = strips[live] * n[live][:, None].astype(np.float32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(live), k, np.int32)), pa.array(live.astype(np.int32)), pa.array(n[live]), *(pa.array(sums[:, j]) for j in range(HIDDEN))], ["part", "strip", "n", *values]
                    )

        return fit

    schema = "part int, strip int, n long, " + ", ".join(f"{w} float" for w in values)
    for k in range(rounds):
        shared = spark.sparkContext.broadcast(m)
        own = docs.select(text, F.monotonically_increasing_id().alias("__at")).where(F.pmod("__at", F.lit(rounds)) == k)
        sums = own.repartition(workers, "__at").select(text).mapInArrow(round_of(shared), schema).groupBy("part", "strip")
        # written, so that the texts and models that this round has shuffled go before the next one
        sums = materialize(sums.agg(*[(F.sum(w) / F.sum("n")).cast("float").alias(w) for w in values]), "model-rows")
        found = sums.toPandas()  # the rows of one model
        release(sums)
        for p, name in enumerate(_PARTS):
            rows = found[found["part"] == p]
            strips = _strips(m[name])
            strips[rows["strip"].to_numpy()] = rows[values].to_numpy(np.float32)
            m[name] = strips.reshape(len(m[name]), -1)[:, : m[name].shape[1]].copy()
        shared.destroy()
    return m


def score(docs: DataFrame, model: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """``docs`` with (n_words, log_prob) added."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for column in batches:
            n_words, sums = [np.zeros(0, np.int64)], [np.zeros(0)]
            for classes, counts in word_classes(pa.array(column, pa.string(), from_pandas=True)):
                ids, at = padded(classes, counts)
                lp = np.r_[0, np.cumsum(log_probs(shared.value, ids, at))]
                edge = np.r_[0, np.cumsum(counts)]
                n_words.append(counts)
                sums.append(lp[edge[1:]] - lp[edge[:-1]])
            yield pd.DataFrame({"n_words": np.concatenate(n_words), "log_prob": np.concatenate(sums)})

    out = docs.withColumn("__lm", F.pandas_udf(run, "n_words long, log_prob double")(F.col(text)))
    return out.withColumn("n_words", F.col("__lm.n_words")).withColumn("log_prob", F.col("__lm.log_prob")).drop("__lm")


def vocabulary(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): all different words of the corpus, by hash, and how often each occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(parts: list[np.ndarray]) -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(parts), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])

        parts, size = [], 0
        for batch in batches:
            for hashes, _ in hashed_words(batch.column(0)):
                parts.append(hashes)
                size += len(hashes)
                if size >= COUNTED:
                    yield counted(parts)
                    parts, size = [], 0
        if size:
            yield counted(parts)

    return docs.select(text).mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def broadcast_from(words: DataFrame) -> int:
    """Least count such that at most FREQUENT words of ``words`` (word, n) have it."""
    top = 4096
    rows = words.groupBy(F.least("n", F.lit(top)).alias("n")).agg(F.count("*").alias("words"), F.sum("n").alias("total")).collect()
    least, room = top + 1, FREQUENT
    for r in sorted(rows, key=lambda r: -r["n"]):
        room -= r["words"]
        if room < 0:
            break
        least = r["n"]
    if least <= top:
        return least
    # at most total / (total / FREQUENT) words have more
    return max(least, sum(r["total"] for r in rows) // FREQUENT + 1)


def score_words(docs: DataFrame, model: dict[str, np.ndarray], words: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with (n_words, log_prob, word_log_prob) added: the sums of the
    log-probabilities of the classes and of the words; ``words``: a table (word, n)."""
    least = broadcast_from(words)
    common = words.where(F.col("n") >= least).toArrow()
    names = common["word"].to_numpy().view(np.uint64)
    order = np.argsort(names)
    log_n = np.log(common["n"].to_numpy()[order]).astype(np.float32)
    totals = class_totals(words)
    # words that occur once, or never, count log 1
    joined = least > 2
    shared = docs.sparkSession.sparkContext.broadcast((model, names[order], log_n, np.log(totals)))

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for column in batches:
            model, names, log_n, log_totals = shared.value
            out = {"n_words": [np.zeros(0, np.int64)], "log_prob": [np.zeros(0)], "word_log_prob": [np.zeros(0)]}
            rest: list[np.ndarray] = []
            for hashes, counts in hashed_words(pa.array(column, pa.string(), from_pandas=True)):
                classes = classes_of(hashes)
                ids, at = padded(classes, counts)
                edge = np.r_[0, np.cumsum(counts)]
                sums = lambda x: (c := np.r_[0, np.cumsum(x)])[edge[1:]] - c[edge[:-1]]  # noqa: B023, E731
                in_class = -log_totals[classes]
                known = np.zeros(len(hashes), bool)
                if len(names):
                    found, back = np.unique(hashes, return_inverse=True)
                    k = np.minimum(np.searchsorted(names, found), len(names) - 1)
                    hit = names[k] == found
                    in_class += np.where(hit, log_n[k], 0)[back]
                    known = hit[back]
                lp = log_probs(model, ids, at)
                out["n_words"].append(counts)
                out["log_prob"].append(sums(lp))
                out["word_log_prob"].append(sums(lp + in_class))
                if joined:
                    cut = np.r_[0, np.cumsum(~known)][edge]
                    rest += np.split(hashes[~known].view(np.int64), cut[1:-1])
                else:
                    rest += [np.zeros(0, np.int64)] * len(counts)
            frame = pd.DataFrame({k: np.concatenate(v) for k, v in out.items()})
            frame["rest"] = pd.Series(rest, dtype=object)
            yield frame

    kept = [F.col(c) for c in docs.columns if c not in (text, "n_words", "log_prob", "word_log_prob")]
    lm = F.pandas_udf(run, "n_words long, log_prob double, word_log_prob double, rest array<long>")(F.col(text))
    rows = docs.withColumn("__lm", lm).withColumn("__row", F.monotonically_increasing_id()).select(*kept, "__row", "__lm.n_words", "__lm.log_prob", "__lm.word_log_prob", F.col("__lm.rest").alias("__rest"))
    if not joined:
        return rows.drop("__row", "__rest")
    rows = materialize(rows, "scored-words")
    tail = rows.select("__row", F.explode("__rest").alias("word")).join(words.where((F.col("n") > 1) & (F.col("n") < least)), "word")
    more = tail.groupBy("__row").agg(F.sum(F.log("n")).alias("__more"))
    out = rows.drop("__rest").join(more, "__row", "left")
    return out.withColumn("word_log_prob", F.col("word_log_prob") + F.coalesce("__more", F.lit(0.0))).drop("__row", "__more")


def op4_masked_lm(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    words = materialize(vocabulary(docs), "word-counts")
    out = score_words(docs, train(docs, words=words), words)
    each = F.greatest("n_words", F.lit(1))
    return out.select(
        "doc_id", "n_words", "log_prob", (F.col("log_prob") / each).alias("per_word"), "word_log_prob", (F.col("word_log_prob") / each).alias("word_per_word")
    )
