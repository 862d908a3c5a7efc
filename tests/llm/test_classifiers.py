"""The classifiers against plain loops: naive Bayes by dictionaries, the convolution window by window."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

pytest.importorskip("clearset.llm")
from clearset.llm import lang_id, toxicity  # noqa: E402
from clearset.llm.text import held_out  # noqa: E402


def bucket(gram: str, buckets: int) -> int:
    h = 0
    for c in gram:
        h = (h * 0x01000193 + ord(c)) % 2**32
    mixed = (h + len(gram)) * 0x9E3779B1 % 2**32
    return (mixed ^ (mixed >> 15)) % buckets


def grams(text: str, buckets: int) -> list[int]:
    t = text.lower()
    return [bucket(t[i : i + n], buckets) for n in lang_id.NGRAMS for i in range(len(t) - n + 1)]


def test_language_is_that_of_plain_naive_bayes(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.where("length(text) < 1500").limit(160).cache()
    buckets, smoothing = 4096, 0.1
    langs, logs = lang_id.train(docs, buckets=buckets, smoothing=smoothing)
    got = {r["doc_id"]: (r["lang_pred"], r["lang_score"]) for r in lang_id.predict(docs, langs, logs).collect()}

    rows = docs.withColumn("out", held_out(docs["doc_id"])).collect()
    counts, n_docs = defaultdict(Counter), Counter()
    for r in rows:
        if r["text"] is not None and r["lang"] is not None and not r["out"]:
            counts[r["lang"]].update(grams(r["text"], buckets))
            n_docs[r["lang"]] += 1
    assert langs == sorted(counts)
    totals = {x: sum(c.values()) + smoothing * buckets for x, c in counts.items()}
    for r in rows:
        text = r["text"] or ""
        if not any(map(str.isalpha, text)):
            assert got[r["doc_id"]] == ("und", 0)
            continue
        own = grams(text, buckets)
        logp = {x: math.log(n_docs[x] / sum(n_docs.values())) + sum(math.log((counts[x][b] + smoothing) / totals[x]) for b in own) for x in langs}
        best = max(logp.values())
        posterior = 1 / sum(math.exp(v - best) for v in logp.values())
        lang, score = got[r["doc_id"]]
        assert logp[lang] == pytest.approx(best, abs=1e-2) and score == pytest.approx(posterior, abs=2e-2)


def test_toxicity_is_that_of_a_direct_convolution():
    model = toxicity.new_model(0.3, seed=4)
    rng = np.random.default_rng(2)
    model.out[:] = rng.normal(size=model.out.shape)
    for w in toxicity.WIDTHS:
        model.bias[w][:] = rng.normal(0, 0.2, model.bias[w].shape)
    texts = ["", "one", "Two words", "a longer text, with signs -- and 12 numbers and repeated repeated words", " ".join(f"w{i % 50}" for i in range(300))]
    got = toxicity.probabilities(model, texts)
    dims = model.embed.shape[1]
    for text, p in zip(texts, got):
        words = re.findall(r"[^\W_]+", text.lower())
        vectors = [sum(model.embed[i].astype(float) for i in toxicity.embedding_rows([w])[0]) for w in words]
        z, column = float(model.out[-1]), 0
        for w in toxicity.WIDTHS:
            # a window starts at each word, and one behind the last
            padded = [*vectors, *[np.zeros(dims)] * w]
            responses = np.array([np.concatenate(padded[i : i + w]) @ model.filters[w].astype(float) for i in range(len(words) + 1)])
            top = np.maximum(responses.max(axis=0) + model.bias[w], 0)
            z += float(top @ model.out[column : column + len(top)])
            column += len(top)
        assert p == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-4)
        assert p == pytest.approx(toxicity.probabilities(model, [text])[0], abs=1e-6)  # whatever lies beside it


def test_toxicity_finds_what_was_held_out(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{data}/labels.parquet").select("doc_id", "toxic")
    model, cuts = toxicity.train(docs, labels)
    got = toxicity.predict(docs, model, cuts).join(labels, "doc_id").where(held_out(docs["doc_id"])).toPandas()
    y, s = got["toxic"].to_numpy(), got["toxic_score"].to_numpy()
    order = np.argsort(np.argsort(s))
    positive = y == 1
    auc = (order[positive].sum() - positive.sum() * (positive.sum() - 1) / 2) / (positive.sum() * (~positive).sum())
    assert auc > 0.8


def test_toxicity_learns_from_every_labelled_row(spark):
    rng = np.random.default_rng(3)
    clean = [f"word{i}" for i in range(300)]
    rows = [(i, " ".join(rng.choice(clean, 60)) + (" badword" if i % 6 == 0 else ""), "en", int(i % 6 == 0)) for i in range(240)]
    # a word of long texts only, and rows that repeat an id
    rows += [(1000 + i, " ".join(rng.choice(clean, 36_000)) + (" longword" if i % 2 else ""), "en", i % 2) for i in range(24)]
    rows += [(2000 + i, " ".join(rng.choice(clean, 20)) + f" copy{k}", "en", 0) for i in range(40) for k in range(2)]
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([(r[0], r[3]) for r in rows], "doc_id long, toxic int")
    kept = docs.where(~held_out(docs["doc_id"]))
    assert toxicity.labelled(docs, marks).count() == kept.count()
    twice = docs.unionByName(docs.where("doc_id < 20"))
    assert toxicity.labelled(twice, marks).count() == kept.count()
    model, _ = toxicity.train(docs, marks, worker_rows=150)
    base, bad, long_ = toxicity.probabilities(model, [" ".join(clean[:40]) + end for end in ("", " badword", " longword")])
    assert base + 0.2 < min(bad, long_)
    again, _ = toxicity.train(docs.repartition(7), marks.repartition(3), worker_rows=150)
    assert np.allclose(again.to_rows(), model.to_rows(), atol=1e-2)


def test_thresholds_are_those_of_all_rows():
    rng = np.random.default_rng(5)
    steps = rng.integers(0, toxicity.CUTS + 1, 400)
    y = (rng.random(400) < steps / toxicity.CUTS).astype(int)
    n, hits = np.bincount(steps, minlength=toxicity.CUTS + 1), np.bincount(steps, y, toxicity.CUTS + 1)
    f1 = lambda cut: 2 * y[steps / toxicity.CUTS >= cut].sum() / ((steps / toxicity.CUTS >= cut).sum() + y.sum())
    assert f1(toxicity.best_threshold(n, hits)) == max(f1(s / toxicity.CUTS) for s in steps)
    assert toxicity.best_threshold(n, n * 0) == 0.5
