"""Toxicity: a small convolutional text classifier trained in numpy.

Words are hashed to rows of an embedding table, as a whole and by the beginnings that are
shorter than the word, so that inflected forms share what they are derived from; filters of
several widths slide over the whole text and are max-pooled into one vector, which a
logistic layer scores.

The model is fitted on every labelled row that is not held out, in ROUNDS: in each, workers (their
number follows from the rows and characters alone) take a share of the rows, dealt by hash, run Adam
over it from the model of the round before, and return the rows of the model that they moved, with
the number of moves; Spark averages them by that weight.  What reaches the driver is one model of
fixed size a round.  Thresholds by language are set before the last round, from every fifth row,
which only the last round fits; F1 is exact over steps of 1/CUTS of the score.

Defined cases: a null or empty text, or one without words, is scored from the biases alone;
long texts are read whole, window by window; without labelled rows every score is 0.5;
rows that repeat a doc_id are fitted and scored each on its own, rows that repeat a text under one id
are fitted once (repeated labels count once, toxic winning); an empty table gives an empty result;
extra columns stay, but columns named toxic_score or toxic_flag give way to the operator's own.
"""

from __future__ import annotations

import copy
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clearset.llm.numbering import Numbers
from clearset.llm.text import held_out, row_key, small_batches
from clearset.storage import checked_broadcast, materialize, release

BUCKETS = 1 << 17
WIDTHS = (1, 2, 3)
#: Lengths of the beginnings that are hashed; words are told apart by LETTERS letters and length.
PREFIXES, LETTERS = (3, 4, 5, 6, 7, 8), 20
#: Rounds of averaging, and passes over a worker's share in each; rows and characters of a share.
ROUNDS, EPOCHS, WORKER_ROWS, WORKER_CHARS = 3, 2, 2048, 1 << 24
#: Steps of the score between which a threshold can lie; rows from which a language has its own.
CUTS, OWN_CUT = 4096, 50
#: Characters that are split into words, and words that are convolved, at once when scoring.
PIECE_CHARS, PIECE = 1 << 22, 1 << 16

_words = re.compile(r"[^\W_]+").findall


def split_words(texts: list[str]) -> tuple[list[np.ndarray], list[str]]:
    """(word codes of each text, the different words they stand for)."""
    index = Numbers([])
    return [np.fromiter(map(index.__getitem__, _words(t.lower())), np.int32) for t in texts], list(index)


def embedding_rows(words: list[str], buckets: int = BUCKETS) -> np.ndarray:
    """Rows of the embedding table that make up each word; ``buckets`` is the empty one."""
    out = np.full((len(words), 1 + len(PREFIXES)), buckets, np.int32)
    if not words:
        return out
    letters = np.array(words, dtype=f"<U{LETTERS}").view(np.uint32).reshape(len(words), LETTERS)
    size = np.fromiter(map(len, words), np.uint32, len(words))
    h = np.zeros(len(words), np.uint32)

    def bucket(x: np.ndarray) -> np.ndarray:
        x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        return (x ^ (x >> np.uint32(13))) % np.uint32(buckets)

    for j in range(LETTERS):
        h = np.where(size > j, h * np.uint32(0x01000193) + letters[:, j], h)
        if j + 1 in PREFIXES:
            out[:, 1 + PREFIXES.index(j + 1)] = np.where(size > j + 1, bucket(h + np.uint32(0x9E3779B1)), buckets)
    out[:, 0] = bucket(h + size * np.uint32(0x85EBCA6B))
    return out


@dataclass
class Model:
    embed: np.ndarray  # buckets + 1 rows (the last one pads) x dims
    filters: dict[int, np.ndarray]  # width -> (width * dims) x filters
    bias: dict[int, np.ndarray]
    out: np.ndarray  # one weight for each filter, and the intercept last

    def vectors(self, rows: np.ndarray) -> np.ndarray:
        """Vectors of words, and of the empty word last."""
        out = np.zeros((len(rows) + 1, self.embed.shape[1]), np.float32)
        for k in range(rows.shape[1]):
            out[:-1] += self.embed[rows[:, k]]
        return out


    def parts(self) -> list[np.ndarray]:
        return [self.embed, *(x for w in WIDTHS for x in (self.filters[w], self.bias[w])), self.out]

    def to_rows(self) -> np.ndarray:
        """All parameters in rows as wide as the embedding, each part beginning a row."""
        dims = self.embed.shape[1]
        return np.concatenate([np.pad(p.reshape(-1), (0, -p.size % dims)).reshape(-1, dims) for p in self.parts()])

    def take_rows(self, rows: np.ndarray) -> None:
        """The opposite: set all parameters."""
        at = 0
        for p in self.parts():
            n = -(-p.size // rows.shape[1])
            p[...] = rows[at : at + n].reshape(-1)[: p.size].reshape(p.shape)
            at += n


def new_model(rate: float, seed: int = 7, buckets: int = BUCKETS, dims: int = 12, filters: int = 12) -> Model:
    rng = np.random.default_rng(seed)
    f = lambda *s: rng.normal(0, 0.3, s).astype(np.float32)
    embed = f(buckets + 1, dims)
    embed /= len(PREFIXES) + 1
    embed[-1] = 0
    logit = np.log(rate / (1 - rate)) if 0 < rate < 1 else 0.0
    return Model(embed, {w: f(w * dims, filters) for w in WIDTHS}, {w: np.zeros(filters, np.float32) for w in WIDTHS}, np.r_[np.zeros(filters * len(WIDTHS)), logit].astype(np.float32))


def padded(docs: list[np.ndarray], pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words in one array, each document followed by pads as wide as the widest filter; where
    each document starts; and the places where none of its windows starts.  A window starts at a word
    or at the first pad behind the last one, so that none reaches the next document."""
    n = max(WIDTHS)
    gap = np.full(n, pad, np.int32)
    parts = [x for d in docs for x in (d.astype(np.int32), gap)]
    starts = np.cumsum([0, *(len(d) + n for d in docs[:-1])])
    ids = np.concatenate([*parts, gap])
    dead = np.zeros(len(ids), bool)
    for k in range(1, n):
        dead[starts + np.fromiter(map(len, docs), np.int64, len(docs)) + k] = True
    return ids, starts, dead


def pooled(model: Model, docs: list[np.ndarray], words: np.ndarray) -> np.ndarray:
    """Max-pooled filter responses of each document; ``words``: vectors of the word codes.
    Pieces of a long document are pooled one after the other."""
    ids, starts, dead = padded(docs, len(words) - 1)
    ends = np.r_[starts[1:], starts[-1] + len(docs[-1]) + max(WIDTHS)]
    n = int(ends[-1])
    out = np.full((len(docs), sum(b.size for b in model.bias.values())), -np.inf, np.float32)
    dims = model.embed.shape[1]
    for at in range(0, n, PIECE):
        to = min(n, at + PIECE)
        vectors = words[ids[at : to + max(WIDTHS) - 1]]
        lo, hi = np.searchsorted(ends, at, "right"), np.searchsorted(starts, to, "left")
        cuts = np.maximum(starts[lo:hi], at) - at
        column = 0
        for w in WIDTHS:
            kernel = model.filters[w]
            response = vectors[: to - at] @ kernel[:dims]
            for j in range(1, w):
                response += vectors[j : to - at + j] @ kernel[j * dims : (j + 1) * dims]
            response[dead[at:to]] = -np.inf
            k = kernel.shape[1]
            part = np.maximum.reduceat(response, cuts, axis=0) + model.bias[w]
            np.maximum(out[lo:hi, column : column + k], part, out=out[lo:hi, column : column + k])
            column += k
    return out


def probabilities(model: Model, texts: list[str]) -> np.ndarray:
    if not texts:
        return np.zeros(0)
    docs, names = split_words(texts)
    words = model.vectors(embedding_rows(names, len(model.embed) - 1))
    z = np.maximum(pooled(model, docs, words), 0) @ model.out[:-1].astype(float) + float(model.out[-1])
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def winning_windows(model: Model, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, dead: np.ndarray, words: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each width, (highest responses of each document's filters, places where they begin); a
    piece of the documents at a time."""
    dims, n = model.embed.shape[1], int(ends[-1])
    tops = [np.zeros((len(starts), model.filters[w].shape[1]), np.int64) for w in WIDTHS]
    best = [np.full(t.shape, -np.inf, np.float32) for t in tops]
    for at in range(0, n, PIECE):
        to = min(n, at + PIECE)
        vectors = words[ids[at : to + max(WIDTHS) - 1]]
        lo, hi = np.searchsorted(ends, at, "right"), np.searchsorted(starts, to, "left")
        for w, top, most in zip(WIDTHS, tops, best):
            k = model.filters[w]
            r = vectors[: to - at] @ k[:dims]
            for j in range(1, w):
                r += vectors[j : to - at + j] @ k[j * dims : (j + 1) * dims]
            r[dead[at:to]] = -np.inf
            for i in range(lo, hi):
                s = max(starts[i], at)
                own = r[s - at : min(ends[i], to) - at]
                first = own.argmax(axis=0)
                value = own[first, np.arange(own.shape[1])]
                higher = value > most[i]
                top[i, higher], most[i, higher] = (s + first)[higher], value[higher]
    return best, tops


def fit(texts: list[str], labels: np.ndarray, epochs: int = ROUNDS * EPOCHS, batch: int = 48, rate: float = 0.02, seed: int = 7, start: Model | None = None, last: bool = True) -> tuple[Model, np.ndarray]:
    """Adam on the log-loss from ``start`` on; only the winning window of each filter gets a gradient.
    ``last``: the last EPOCHS take smaller steps.  (model, how often each row of ``to_rows`` moved)."""
    model = start or new_model(float(np.mean(labels)) if len(labels) else 0.5, seed)
    moved = np.zeros(len(model.to_rows()), np.int64)
    if not len(labels):
        return model, moved
    rng = np.random.default_rng(seed)
    docs, names = split_words(texts)
    table = embedding_rows(names, len(model.embed) - 1)
    empty, dims = len(names), model.embed.shape[1]
    state: dict = {}
    step = 0

    def adam(name, param: np.ndarray, grad: np.ndarray, rows=None) -> None:
        if name not in state:
            state[name] = (np.zeros_like(param), np.zeros_like(param))
        m, v = state[name]
        at = slice(None) if rows is None else rows
        m[at] = 0.9 * m[at] + 0.1 * grad
        v[at] = 0.99 * v[at] + 0.01 * grad**2
        param[at] -= rate * (m[at] / (1 - 0.9 ** min(step, 100))) / (np.sqrt(v[at] / (1 - 0.99 ** min(step, 1000))) + 1e-6)

    order = np.arange(len(docs))
    for epoch in range(epochs):
        rng.shuffle(order)
        if last and epoch == max(epochs - EPOCHS, 0):
            rate *= 0.3
        for b in range(0, len(order), batch):
            own = order[b : b + batch]
            step += 1
            ids, starts, dead = padded([docs[i] for i in own], empty)
            ends = np.r_[starts[1:], len(ids) - max(WIDTHS)]
            seen_words, ids = np.unique(ids, return_inverse=True)
            rows_of = np.full((len(seen_words), table.shape[1]), len(model.embed) - 1, np.int32)
            rows_of[seen_words < empty] = table[seen_words[seen_words < empty]]
            words = model.vectors(rows_of)
            best, winners = winning_windows(model, ids, starts, ends, dead, words)
            h = np.concatenate([r + model.bias[w] for w, r in zip(WIDTHS, best)], axis=1)
            active = np.maximum(h, 0)
            p = 1 / (1 + np.exp(-np.clip(active @ model.out[:-1] + model.out[-1], -30, 30)))
            d = ((p - labels[own]) / len(own)).astype(np.float32)
            dh = np.outer(d, model.out[:-1]) * (h > 0)
            grads: dict[int, tuple] = {}
            column, rows, row_grads = 0, [], []
            for w, top in zip(WIDTHS, winners):
                k = model.filters[w]
                g = dh[:, column : column + k.shape[1]]
                column += k.shape[1]
                seen = ids[top[..., None] + np.arange(w)]  # doc x filter x width
                x = words[seen].reshape(*top.shape, w * dims)
                grads[w] = (np.einsum("df,dfk->kf", g, x), g.sum(axis=0))
                back = (g[..., None] * k.T[None]).reshape(-1, dims)
                rows.append(seen.reshape(-1))
                row_grads.append(back)
            adam("out", model.out, np.r_[active.T @ d, d.sum()] + 1e-4 * model.out)
            for w in WIDTHS:
                adam(("k", w), model.filters[w], grads[w][0])
                adam(("b", w), model.bias[w], grads[w][1])
            flat = rows_of[np.concatenate(rows)]  # every row that a word is made of gets its gradient
            at, inverse = np.unique(flat, return_inverse=True)
            total = np.zeros((len(at), dims), np.float32)
            np.add.at(total, inverse.reshape(-1), np.repeat(np.concatenate(row_grads), flat.shape[1], axis=0))
            live = (at != len(model.embed) - 1) & (np.abs(total).sum(axis=1) > 0)
            adam("embed", model.embed, total[live], at[live])
            moved[at[live]] += 1
    moved[len(model.embed) :] = step
    return model, moved


def labelled(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(key, text, lang, toxic) of all labelled rows that are not held out; rows that repeat a text under
    one id count once."""
    own = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    own = own.groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").cast("int").alias("toxic"))
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    own = materialize(own, "labels")
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"), lang.alias("lang"))
    found = rows.join(checked_broadcast(own), F.col("id") == F.col("__id"))
    found = found.groupBy(row_key(F.col("id"), F.col("text")).alias("key"), "id", "toxic").agg(F.min(F.struct("text", "lang")).alias("row"))
    out = materialize(found.select("key", "row.text", "row.lang", "toxic"), "labelled-rows")
    release(own)
    return out


def best_threshold(n: np.ndarray, hits: np.ndarray) -> float:
    """The score from which on F1 is largest, from the rows and the toxic ones of each step of the
    score; 0.5 where a class is missing."""
    if hits.sum() in (0, n.sum()):
        return 0.5
    caught, flagged = np.cumsum(hits[::-1])[::-1], np.cumsum(n[::-1])[::-1]
    f1 = np.where(n > 0, 2 * caught / np.maximum(flagged + hits.sum(), 1), -1)
    best = len(f1) - 1 - int(f1[::-1].argmax())
    below = np.flatnonzero(n[:best])
    return float((best + below[-1] + 1) / 2 if len(below) else best) / CUTS  # midway to the next rows below


def calibrated(scored: DataFrame) -> dict[str, float]:
    """Threshold by language ("" for all others) from all rows of (lang, toxic, toxic_score)."""
    lang, step = F.coalesce("lang", F.lit("")).alias("lang"), F.floor(F.col("toxic_score") * CUTS).cast("int").alias("step")
    steps = materialize(scored.groupBy(lang, step).agg(F.count("*").alias("n"), F.sum("toxic").alias("hits")), "toxic-steps")
    own = steps.withColumn("rows", F.sum("n").over(Window.partitionBy("lang"))).where((F.col("rows") >= OWN_CUT) & (F.col("lang") != ""))
    every = steps.groupBy("step").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))

    def cut(rows: pd.DataFrame) -> float:
        n, hits = (np.bincount(rows["step"], rows[c].astype(float), CUTS + 1) for c in ("n", "hits"))
        return best_threshold(n, hits)

    cuts = {name: cut(rows) for name, rows in own.toPandas().groupby("lang")} | {"": cut(every.toPandas())}
    release(steps)
    return cuts


def train(docs: DataFrame, labels: DataFrame, worker_rows: int = WORKER_ROWS) -> tuple[Model, dict[str, float]]:
    """The model fitted on all labelled rows and its threshold by language ("" for all others)."""
    spark = docs.sparkSession
    table = labelled(docs, labels)
    n, toxic, chars = table.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    model = new_model(toxic / n if n else 0.5)
    if not 0 < toxic < n:
        cuts = calibrated(predict(table, model))
        release(table)
        return model, cuts
    workers = max(1, -(-n // worker_rows), -(-chars // WORKER_CHARS))
    shares = table.withColumn("share", F.pmod(F.xxhash64("key"), F.lit(workers)).cast("int"))
    later = F.pmod(F.xxhash64(F.lit("later"), "key"), F.lit(5)) == 4
    values = [f"w{j}" for j in range(model.embed.shape[1])]

    def share_of(shared: Broadcast, k: int) -> Callable[[pa.Table], pa.Table]:
        def run(rows: pa.Table) -> pa.Table:
            rows = rows.sort_by("key")
            m, moved = fit(rows["text"].to_pylist(), rows["toxic"].to_numpy().astype(np.float32), EPOCHS, seed=7 + k, start=copy.deepcopy(shared.value), last=k == ROUNDS - 1)
            live = np.flatnonzero(moved)
            sums = m.to_rows()[live] * moved[live][:, None].astype(np.float32)
            return pa.table([pa.array(live.astype(np.int32)), pa.array(moved[live]), *(pa.array(sums[:, j]) for j in range(len(values)))], ["row", "n", *values])

        return run

    cuts: dict[str, float] = {}
    for k in range(ROUNDS):
        own = shares if k == ROUNDS - 1 else shares.where(~later)
        if k == ROUNDS - 1:  # the rows set apart have not been fitted yet
            cuts = calibrated(predict(table.where(later), model))
        shared = spark.sparkContext.broadcast(model)
        sums = own.select("share", "key", "text", "toxic").groupBy("share").applyInArrow(share_of(shared, k), "row int, n long, " + ", ".join(f"{w} float" for w in values))
        sums = materialize(sums.groupBy("row").agg(*[(F.sum(w) / F.sum("n")).cast("float").alias(w) for w in values]), "model-rows")
        found, rows = sums.toPandas(), model.to_rows()  # the rows of one model
        rows[found["row"].to_numpy()] = found[values].to_numpy(np.float32)
        model.take_rows(rows)
        release(sums)
        shared.destroy()
    release(table)
    return model, cuts


def predict(docs: DataFrame, model: Model, thresholds: dict[str, float] | None = None, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with toxic_score added and, given thresholds and a language column, toxic_flag."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in batches:
            texts = [t if isinstance(t, str) else "" for t in column]
            out, first, n = np.zeros(len(texts)), 0, 0
            for i, t in enumerate(texts):  # a few megabytes at a time
                n += len(t)
                if n > PIECE_CHARS or i + 1 == len(texts):
                    out[first : i + 1] = probabilities(shared.value, texts[first : i + 1])
                    first, n = i + 1, 0
            yield pd.Series(out)

    out = docs.withColumn("toxic_score", F.pandas_udf(score, "double")(F.col(text)))
    if thresholds and lang in docs.columns:
        cut = F.create_map(*[F.lit(x) for kv in thresholds.items() for x in kv])
        out = out.withColumn("toxic_flag", F.col("toxic_score") >= F.coalesce(cut[F.coalesce(F.col(lang), F.lit(""))], F.lit(thresholds[""])))
    return out


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model, thresholds = train(docs, labels)
    out = predict(docs, model, thresholds)
    return out.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.3).cast("int").alias("predicted"), "toxic_flag"
    )
