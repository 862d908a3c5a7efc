"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

public_tokenizers = pytest.importorskip("public_tokenizers")

from clearset.llm import decontamination, graph_ann, lang_id, line_dedup, masked_lm, ngram_join, secrets, sentencepiece_viterbi as spv, shingles, simple8b, token_files, toxicity  # noqa: E402
from clearset.storage import materialize  # noqa: E402

LONG = " ".join(f"w{i % 977} x{i % 13}" for i in range(30_000))
SCHEMA = "doc_id long, text string, lang string, source string, doc string, rk string, n string, v string, pos string, key string, start string, end string"
BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def messy(spark):
    texts = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (3, "one"), (4, LONG), (None, "no id at all here"), (5, "1234 .. 5678"), (6, "Ünï çødé 日本語 \U0001f600 text"), (7, "a\nb\n\na"), (3, "another text under the same id")]
    rows = [(i, t, None if i == 2 else "en", None if i == 1 else f"s{(i or 0) % 2}", *["clash"] * 8) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(messy):
    return messy.limit(0)


def test_simple8b_round_trip_with_escapes():
    rng = np.random.default_rng(0)
    for n in (0, 1, 59, 60, 61, 1023, 1024, 1025, 5000):
        for top in (1, 2, 300, 50_000, 2**20, 2**40, 2**63):
            x = (rng.random(n) * top).astype(np.uint64)
            if n > 10:
                x[5:9] = 2**64 - 1, 2**60 - 1, 0, 2**60
            words, offsets = simple8b.encode(x)
            assert (simple8b.decode(words, offsets, n) == x).all()
            if n > simple8b.BLOCK:  # one block alone
                a, b = offsets[1:3]
                part = simple8b.decode(words[a:b], np.array([0, b - a]), min(n - simple8b.BLOCK, simple8b.BLOCK))
                assert (part == x[simple8b.BLOCK : 2 * simple8b.BLOCK]).all()


def test_token_encoder_equals_the_library():
    own = token_files.encoder(BPE, public_tokenizers.PATTERN)
    texts = ["", " ", "  a", "a  ", "a \n b", "it's 'x' don't", "\n\n x", "é ü", "日本語 テスト", "a<|endoftext|>b", "x  y", "a\x1c b", "\x00 \x00", "tab\tx", "12 3.4", "a  b", "_foo bar_", LONG[:3000]]
    ids, counts = own.encode(texts)
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [p.tolist() for p in parts] == [e.ids for e in own.whole.encode_batch(texts, add_special_tokens=False)]


def test_token_files(spark, messy, empty, tmp_path):
    for name, df, rows in (("a", messy, 11), ("b", empty, 0)):
        token_files.write_segments(df, str(tmp_path / name), BPE, public_tokenizers.PATTERN)
        got = token_files.read_segments(spark, str(tmp_path / name)).orderBy("start").collect()
        assert len(got) == rows
        assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(got, got[1:]))
    ids = [r["doc_id"] for r in token_files.read_segments(spark, str(tmp_path / "a")).orderBy("start").collect()]
    assert ids == [None, 0, 1, 2, 3, 3, 3, 4, 5, 6, 7]


def test_secrets(spark, messy, empty):
    key = "AKIA" + "ABCDEFGH12345678"
    rows = [(0, f"x password: hunter22 {key}", "a"), (1, f"Token='{'0a' * 14}'", "a"), (2, f"{key} again", "b"), (3, None, None), (4, "secret=short token=abc secret=token:abcdefg", "c"), (5, "é Zq3Wv9Lk2Pp8Rt5Yb7Nc1", "d"), (5, "é Zq3Wv9Lk2Pp8Rt5Yb7Nc1", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc"]: r for r in secrets.scan(df).select("doc", secrets.listed(F.col("base")).alias("base"), secrets.listed(F.col("added")).alias("added"), F.transform("base", lambda s: s["live"]).alias("live")).collect()}
    assert got[0]["base"] == "assign:2:20,access:21:41" and got[0]["live"] == [True, False]  # two owners hold the key
    assert got[1]["base"] == "assign:0:35,hex:7:35"
    assert 3 not in got and 4 not in got  # 'abc' and 'token' are too short, and matches do not overlap
    assert (got[5]["base"], got[5]["added"]) == ("", "opaque:2:23")
    assert secrets.scan(messy).count() == 0 and secrets.scan(empty).count() == 0


def test_graph_search_ties_repeats_and_bad_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 8))
    rows = [(i, base[i % 60 if i < 300 else 0].tolist(), "x") for i in range(400)]
    rows += [(1000, None, "x"), (1001, [0.0] * 8, "x"), (1002, [float("nan")] + [1.0] * 7, "x"), (1003, [None] + [1.0] * 7, "x"), (1004, [1.0], "x"), (1005, [], "x"), (7, base[7].tolist(), "x"), (None, [1.0] * 8, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, key string")
    got = graph_ann.nearest(df, F.col("vec_id") % 20 == 0, k=20, shard_size=25).toPandas()
    ids = np.arange(400)
    x = base[np.where(ids < 300, ids % 60, 0)]
    for q in ids[::20]:
        s = np.round(x @ x[q], 9)
        want = [i for i in ids[np.lexsort((ids, -s))] if i != q][:20]
        assert got[got["query_id"] == q].sort_values("rank")["vec_id"].tolist() == want
    assert set(got["query_id"]) == set(range(0, 400, 20))
    few = graph_ann.nearest(df.where("vec_id < 4"), F.col("vec_id") % 2 == 0, k=20).toPandas()
    assert few.groupby("query_id").size().to_dict() == {0: 3, 2: 3}
    assert graph_ann.nearest(df.limit(0), F.lit(True)).count() == 0


def test_masked_model_is_a_distribution_and_sums_over_all_words(spark, messy, empty):
    model = masked_lm.train(messy)
    ids = np.array([masked_lm.PAD] * 2 + [5, 900, 17] + [masked_lm.PAD] * 2, np.int32)
    total = 0.0
    for c in range(masked_lm.CLASSES):
        ids[3] = c
        total += np.exp(masked_lm.log_probs(model, ids, np.array([3]))[0])
    assert total == pytest.approx(1, abs=1e-3)
    got = masked_lm.score(messy, model).toPandas()
    assert got["n_words"].tolist() == [len((t or "").encode().split()) for t in got["text"]]
    for r in got[(got["n_words"] > 0) & (got["n_words"] < 100)].itertuples():
        h, counts = shingles.word_hashes(np.frombuffer(r.text.encode(), np.uint8), np.array([0, len(r.text.encode())]))
        ids, at = masked_lm.padded((h % np.uint64(masked_lm.CLASSES)).astype(np.int32), counts)
        assert r.log_prob == pytest.approx(sum(masked_lm.log_probs(model, ids, np.array([i]))[0] for i in at), rel=1e-4)
    assert (got[got["n_words"] == 0]["log_prob"] == 0).all()
    assert masked_lm.score(empty, masked_lm.train(empty)).count() == 0


def plain_step(m, moved, ids, at, rate=masked_lm.RATE):
    """The same step with tables read by indexing and rows summed by differences of running totals."""
    side, n_at = masked_lm.SIDE, len(at)
    high, low, i, rows = ids[at] // side, ids[at] % side, np.arange(n_at), masked_lm.contexts(ids, at)
    h = m["embed"][rows[0]]
    for r in rows[1:]:
        h += m["embed"][r]
    np.tanh(h, out=h)
    z = h @ m["high"].T
    z += m["high_bias"].T
    h2 = h + m["given"][high]
    z2 = h2 @ m["low"].T
    z2 += m["low_bias"][high]
    (d1, sum1), (d2, sum2) = masked_lm._odds(z), masked_lm._odds(z2)
    d1 /= sum1[:, None]
    d2 /= sum2[:, None]
    d1[i, high] -= 1
    d2[i, low] -= 1
    back2 = d2 @ m["low"]
    back = (d1 @ m["high"] + back2) * (1 - h * h)
    scale = rate * 30 / n_at
    m["high"] -= scale * (d1.T @ h)
    m["low"] -= scale * (d2.T @ h2)
    m["high_bias"] -= scale * d1.sum(axis=0)[:, None]
    own = (high == np.arange(side)[:, None]).astype(np.float32)
    n = own.sum(axis=1)
    pace = (rate / np.sqrt(np.maximum(n, 1)))[:, None]
    m["given"] -= pace * (own @ back2)
    m["low_bias"] -= pace * (own @ d2)
    for name in ("given", "low_bias"):
        moved[name] += n.astype(np.int64)
    flat = rows.ravel()
    order = np.argsort(flat.astype(np.int16), kind="stable")
    heads = np.flatnonzero(np.r_[True, np.diff(flat[order]) != 0])
    n = np.diff(heads, append=len(flat))
    total = np.diff(np.cumsum(back[order % n_at], axis=0, dtype=np.float64)[heads + n - 1], axis=0, prepend=0)
    total *= (rate / np.sqrt(n))[:, None]
    m["embed"][flat[order][heads]] -= total.astype(np.float32)
    moved["embed"][flat[order][heads]] += n
    for name in ("high", "low", "high_bias"):
        moved[name] += n_at


def test_a_step_equals_the_plain_one_in_less_time():
    rng = np.random.default_rng(0)
    often = rng.permutation(masked_lm.CLASSES)[np.minimum(rng.pareto(0.5, 40 * masked_lm.BATCH), masked_lm.CLASSES - 1).astype(int)]
    ids, at = masked_lm.padded(often.astype(np.int32), np.full(40, masked_lm.BATCH))
    at = rng.permutation(at)
    models, took = [], []
    for take in (masked_lm.step, plain_step):
        m = masked_lm.start()
        models.append((m, {k: np.zeros(len(v), np.int64) for k, v in m.items()}))
        took.append([])
    for a in range(0, len(at), masked_lm.BATCH):
        for (m, moved), take, times in zip(models, (masked_lm.step, plain_step), took):
            began = time.thread_time()
            take(m, moved, ids, at[a : a + masked_lm.BATCH])
            times.append(time.thread_time() - began)
    (m, moved), (want, want_moved) = models
    assert all(np.allclose(m[k], want[k], rtol=0, atol=1e-5) and (moved[k] == want_moved[k]).all() for k in m)
    assert np.median(took[0]) < 0.9 * np.median(took[1])


@pytest.mark.parametrize("frequent", [1 << 20, 3])
def test_words_of_one_class_are_told_apart(spark, messy, empty, monkeypatch, frequent):
    monkeypatch.setattr(masked_lm, "FREQUENT", frequent)
    seen = spark.createDataFrame([(i, "the cat the dog " * 3 + "pair" * (i > 7)) for i in range(10)], "doc_id long, text string").unionByName(messy.select("doc_id", "text"))
    model, words = masked_lm.train(seen), materialize(masked_lm.vocabulary(seen), "word-counts")
    hashed = lambda t: shingles.word_hashes(np.frombuffer((t or "").encode(), np.uint8), np.array([0, len((t or "").encode())]))[0].tolist()
    n = {}
    for r in seen.collect():
        for h in hashed(r["text"]):
            n[h] = n.get(h, 0) + 1
    assert {r["word"] % (1 << 64): r["n"] for r in words.collect()} == n
    total = {}
    for h, k in n.items():
        total[h % masked_lm.CLASSES] = total.get(h % masked_lm.CLASSES, 0) + k
    docs = seen.unionByName(spark.createDataFrame([(77, "never zzyzx dog"), (77, "never zzyzx dog")], "doc_id long, text string"))
    whole = masked_lm.score(docs, model).toPandas().sort_values(["doc_id", "text"], ignore_index=True)
    got = masked_lm.score_words(docs.withColumn("t", F.col("text")), model, words).toPandas().sort_values(["doc_id", "t"], ignore_index=True)
    assert got["n_words"].tolist() == whole["n_words"].tolist() and np.allclose(got["log_prob"], whole["log_prob"], rtol=1e-4)
    want = [sum(np.log(n.get(h, 1) / (total.get(h % masked_lm.CLASSES, 0) + 1)) for h in hashed(t)) for t in got["t"]]
    assert np.allclose(got["word_log_prob"] - got["log_prob"], want, rtol=1e-4, atol=1e-4)
    assert masked_lm.score_words(empty.select("doc_id", "text"), model, words).count() == 0


def test_masked_model_does_not_depend_on_partitions(spark, monkeypatch):
    # words of two kinds of documents: every word but the first of a chain follows from its neighbours
    monkeypatch.setattr(masked_lm, "FEW_WORDS", 1 << 15)
    rng = np.random.default_rng(1)
    def text():
        return " ".join(f"k{(a + i) % 300}" for a in rng.integers(0, 300, 20) for i in range(12))
    kept = spark.createDataFrame([(i, text()) for i in range(1000)], "doc_id long, text string")
    own = [text() for _ in range(60)]
    mixed = [" ".join(rng.permutation(t.split())) for t in own]
    held = spark.createDataFrame(list(enumerate(own + mixed)), "doc_id long, text string")
    words = materialize(masked_lm.vocabulary(kept), "word-counts")
    means = []
    for n in (4, 64):
        got = masked_lm.score(held, masked_lm.train(kept.repartition(n), words=words)).orderBy("doc_id").toPandas()
        each = (got["log_prob"] / got["n_words"]).to_numpy()
        assert (each[:60] > each[60:]).all()  # the words of a text in another order are less likely
        means.append(each[:60].mean())
    counts = masked_lm.class_totals(words)
    unigram = masked_lm.start(counts)
    unigram["embed"][:] = 0
    unigram["given"][:] = 0
    base = masked_lm.score(held.where("doc_id < 60"), unigram).selectExpr("sum(log_prob) / sum(n_words)").first()[0]
    assert base == pytest.approx(-np.log(300), abs=0.3)
    assert abs(means[0] - means[1]) < 0.1 and min(means) > base + 0.5


def lines_brute(rows, least=10):
    key = lambda x: re.sub(r"^[ \t-\r]+|[ \t-\r]+$", "", re.sub("[A-Z]", lambda m: m[0].lower(), x))
    seen = {}
    for i, t in set(rows):
        for k in {key(x) for x in (t or "").split("\n")}:
            seen.setdefault(k, set()).add((i, t))
    gone = {k for k, s in seen.items() if len(s) >= least and k}
    return {(i, t): "\n".join(x for x in (t or "").split("\n") if key(x) not in gone) for i, t in rows}


def test_line_dedup(spark, messy, empty):
    rows = [(i, f"Common É line \nown {i}\n\ncommon É line" if i % 2 else f"COMMON É line\n{'y' * i}") for i in range(24)] + [(100, None), (101, "\n".join(["own 1"] * 300 + ["z", "common É line"])), (3, "Common É line \nown 3\n\ncommon É line")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = line_dedup.apply_bitmaps(df, line_dedup.keep_bitmaps(df)).toPandas()
    want = lines_brute(rows)
    assert [want[(r.doc_id, r.text)] for r in got.itertuples()] == got["kept_text"].tolist()
    assert got["n_lines"].tolist() == [len((t or "").split("\n")) for t in got["text"]]
    first = line_dedup.apply_bitmaps(df, line_dedup.keep_bitmaps(df, mode="first")).toPandas().set_index("doc_id")
    assert first.loc[0, "kept_text"] == "COMMON É line\n" and first.loc[5, "kept_text"] == "own 5\n"
    out = line_dedup.apply_bitmaps(messy, line_dedup.keep_bitmaps(messy, min_docs=2))
    assert out.count() == 11 and set(messy.columns) <= set(out.columns)
    assert line_dedup.keep_bitmaps(empty).count() == 0 and line_dedup.apply_bitmaps(empty, line_dedup.keep_bitmaps(empty)).count() == 0


def test_language_id(spark, messy, empty):
    langs, logs = lang_id.train(messy)
    got = [(r["text"], r["lang_pred"], r["lang_score"]) for r in lang_id.predict(messy, langs, logs).collect()]
    assert len(got) == 11
    assert all((p, s) == ("und", 0) for t, p, s in got if not any(map(str.isalpha, t or "")))
    assert all(p == "en" for t, p, _ in got if t and any(map(str.isalpha, t)))
    assert lang_id.predict(messy, *lang_id.train(empty)).where("lang_pred <> 'und'").count() == 0
    assert lang_id.predict(empty, langs, logs).count() == 0


def test_language_pieces_equal_the_whole(monkeypatch):
    text = [LONG[:5000], "ab", "", "xyz " * 400]
    whole = lang_id.bucket_sums(text, np.arange(lang_id.BUCKETS, dtype=float)[:, None] % 97)
    monkeypatch.setattr(lang_id.pieces, "__defaults__", (700,))
    assert np.allclose(whole, lang_id.bucket_sums(text, np.arange(lang_id.BUCKETS, dtype=float)[:, None] % 97))


def test_toxicity_finds_planted_words_wherever_they_are(spark, messy, empty):
    rng = np.random.default_rng(1)
    clean = [f"word{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(600):
        words = rng.choice(clean, rng.integers(20, 200)).tolist()
        if bad := int(i % 5 == 0):
            words[int(rng.integers(len(words)))] = ["badword", "nastyones"][i % 2]
        rows.append((i, " ".join(words), "en"))
        labels.append((i, bad))
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string, lang string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    model, cuts = toxicity.train(docs, marks)
    got = toxicity.predict(docs, model, cuts).toPandas().set_index("doc_id")
    held = [i for i in range(600) if __import__("zlib").crc32(str(i).encode()) % 4 == 2]
    right = [(got.loc[i, "toxic_score"] >= 0.3) == (i % 5 == 0) for i in held]
    assert np.mean(right) > 0.95
    assert toxicity.predict(messy, model, cuts).count() == 11 and toxicity.predict(empty, model).count() == 0
    none, cut = toxicity.train(docs, marks.limit(0))
    assert cut == {"": 0.5} and set(toxicity.predict(docs, none).toPandas()["toxic_score"].round(6)) == {0.5}


def test_long_documents_pool_in_pieces(monkeypatch):
    model = toxicity.new_model(0.5)
    model.out[:-1] = 1
    texts = [LONG[:9000], "a b", "", "c " * 700]
    whole = toxicity.probabilities(model, texts)
    monkeypatch.setattr(toxicity, "PIECE", 50)
    assert np.allclose(whole, toxicity.probabilities(model, texts))


def hits_brute(text, items, size=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, found = words(text), set(), set()
    for item, t in items:
        iw = words(t)
        n = min(size, len(iw))
        grams = {tuple(iw[j : j + n]) for j in range(len(iw) - n + 1)} if n else set()
        for p in range(len(w) - n + 1) if n else []:
            if tuple(w[p : p + n]) in grams:
                hit |= set(range(p, p + n))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


def test_decontamination(spark, messy, empty):
    rng = np.random.default_rng(4)
    w = [f"t{i}" for i in range(40)]
    text = lambda n: " ".join(rng.choice(w, n))
    items = [(i, text(n)) for i, n in enumerate([30, 12, 10, 9, 4, 1, 0])] + [(7, None), (10, "É é Straße x"), (0, "t1 t2"), (2, text(11))]
    rows = []
    for i in range(60):
        t = items[i % 6][1].split()
        a = int(rng.integers(0, max(1, len(t) - 9)))
        rows.append((i, f"{text(int(rng.integers(0, 30)))} {'-'.join(t[a : a + int(rng.integers(5, 20))]).upper()}, {text(5)}"))
    rows += [(100, None), (101, ""), (102, "é É STRAßE X"), (5, rows[5][1])]
    df, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.decontaminate(df, bench).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_words"], r["n_hit"], r["items"]) == hits_brute(r["text"], items), r["doc_id"]
    assert decontamination.decontaminate(messy, bench).count() == 11
    assert decontamination.decontaminate(df, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontamination.decontaminate(empty, bench).count() == 0


def test_streaming_search_commits_within_a_bounded_window():
    v = spv.load_vocabulary(PIECES)
    s = spv.StreamingViterbi(v)
    s.feed("thequickbrown" * 3000)
    ids = s.finish()
    assert s.most_kept <= 4 * v.longest
    assert spv.Decoder(v).decode(np.array(ids)) == "thequickbrown" * 3000


def test_side_by_side_equals_the_stream(messy):
    v = spv.load_vocabulary(PIECES)
    texts = [r["text"] or "" for r in messy.collect()] + [" lead", "two  spaces ", "\x00z", "x" * 500, "\n\n\t"]
    ids, counts = spv.encode_batch(v, texts)
    parts = [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])]
    short = [i for i, t in enumerate(texts) if len(t) < 2000]
    assert [parts[i] for i in short] == [spv.stream(v, spv.MARK + texts[i].replace(" ", spv.MARK)) if texts[i] else [] for i in short]
    assert [spv.Decoder(v).decode(np.array(p, int)) for p in parts] == texts


def best_ids_brute(v, text):
    """Unbounded search with equal sums going to the longest last piece."""
    best = [(0.0, 0, -1)]
    for end in range(1, len(text) + 1):
        tries = [(best[end - k][0] + v.scores[v.ids[text[end - k : end]]], k, v.ids[text[end - k : end]]) for k in range(1, end + 1) if text[end - k : end] in v.ids]
        best.append(max(tries if text[end - 1] in v.ids else [*tries, (best[end - 1][0] + v.unknown, 1, -1)], key=lambda t: t[:2]))
    ids, at = [], len(text)
    while at:
        _, k, i = best[at]
        ids[:0] = [i] if i >= 0 else spv.unknown_ids(v, text[at - 1])
        at -= k
    return ids


@pytest.mark.parametrize("seed", range(6))
def test_lanes_of_any_lengths_equal_an_unbounded_search(seed):
    rng = np.random.default_rng(seed)
    text = lambda n: "".join(rng.choice(list("abcé▁"), n))
    pieces = ["<unk>", *sorted({text(int(n)) for n in rng.integers(1, 6, 60)} - {"c"})]  # marks inside pieces: texts stay whole
    v = spv.Vocabulary(pieces, -rng.integers(1, 6, len(pieces)).astype(float), np.arange(1, len(pieces)), None, 0)  # many equal sums
    texts = [text(int(n)) for n in (0, 1, 9, 10, 11, 40, 41, 300)] + [text(3) * 50, ""]
    ids, counts = spv.side_by_side(v, texts)
    assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == [best_ids_brute(v, t) for t in texts]
    assert spv.side_by_side(v, [""])[1].tolist() == [0] and not v.words_apart


def test_lanes_keep_a_window_only():
    v = spv.load_vocabulary(PIECES)
    s, texts = spv.StreamingViterbi(v, 3), ["thequickbrown" * 4000, "日本語テキスト" * 8000, "x-" * 26000]
    for a in range(0, 52000, s.chunk):
        s.step(np.stack([spv.codes_of(t[a : min(a + s.chunk, 52000)]) for t in texts]))
        s.commit()
    assert s.most_kept <= 4 * v.longest and s.best.shape[1] == v.longest and s.tail.shape[1] < v.longest
    s.close(np.full(3, 52000))
    ids, counts = s.result(3)
    assert [spv.Decoder(v).decode(p) for p in np.split(ids, np.cumsum(counts)[:-1])] == [t[:52000] for t in texts]


def test_two_searches_in_one_pass(messy):
    got = spv.encode(messy, PIECES, also="merges", digest=True).orderBy("doc_id", "ids_crc32").collect()
    for search, front in (("scores", ""), ("merges", "merges_")):
        alone = spv.encode(messy, PIECES, digest=True, search=search)
        assert sorted((str(r["doc_id"]), r["n_pieces"], r["ids_crc32"]) for r in alone.collect()) == sorted((str(r["doc_id"]), r[front + "n_pieces"], r[front + "ids_crc32"]) for r in got)


def test_words_of_a_task_are_searched_once(spark, monkeypatch):
    v = spv.load_vocabulary(PIECES)
    batches = [["the quick brown", "the  end", ""], ["the quick end 日本", "brown\nfox"], [""], ["x " * 30 + "the", "fox the"]]
    own = {k: [] for k in ("scores", "merges")}
    monkeypatch.setattr(spv, "SEARCHES", {k: lambda v, words, k=k, f=f: own[k].append(words) or f(v, words) for k, f in spv.SEARCHES.items() if k in own})
    want = [spv.encode_batch(v, b, *own) for b in batches]
    for most, once in ((1000, True), (0, False), (10, False)):
        own["scores"].clear(), own["merges"].clear()
        known = spv.KnownWords(v, list(own), most)
        for b, w in zip(batches, want):
            assert all(np.array_equal(x, y) for x, y in zip(spv.encode_batch(v, b, *own, known=known), w, strict=True))
        for words in own.values():
            met = [w for part in words for w in part]
            assert (len(met) == len(set(met))) == once
    asked, docs = {}, spark.sql("SELECT 1L AS doc_id, 'a' AS text, 1 AS n_pieces, 1 AS ids_crc32, true AS round_trip, 1 AS merges_n_pieces, 1 AS merges_ids_crc32, true AS merges_round_trip")
    monkeypatch.setattr(spv, "encode", lambda *a, **k: asked.update(k) or docs)
    spv.op9_sentencepiece(spark, "/root/testdata/sf0.001")
    assert asked["known_chars"] == spv.KNOWN_CHARS > 0 and asked["also"] == "merges"


def test_sentencepiece_columns(messy, empty):
    coded = spv.encode(messy, PIECES)
    assert coded.count() == 11 and coded.where("NOT round_trip").count() == 0
    assert spv.decode(coded, PIECES).where("decoded <> coalesce(text, '')").count() == 0
    assert spv.encode(empty, PIECES).count() == 0


def test_merges_equal_the_library_on_whole_texts(spark, data, messy, empty):
    import sentencepiece

    whole = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    odd = ["...Erreth", " lead", "two  spaces ", "\x00z", "x" * 500, "\n\n\t", "a▁b ▁ c", "▁", "\u00a0x", "the" * 9000]
    docs = messy.select("text").unionByName(spark.createDataFrame([(t,) for t in odd], "text string")).unionByName(spark.read.parquet(f"{data}/documents.parquet").select("text"))
    got = spv.encode(docs, PIECES, search="merges").collect()
    assert len(got) > 200 and all(r["piece_ids"] == whole.encode(r["text"] or "") for r in got)
    # the model has no other piece for a mark in the text than that of a space
    assert all(r["round_trip"] == (spv.MARK not in (r["text"] or "")) for r in got)
    assert spv.encode(empty, PIECES, search="merges").count() == 0


def components_brute(rows, percent, n):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            k = len(a & sets[j])
            if a and sets[j] and 100 * k >= percent * (len(a) + len(sets[j]) - k):
                parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return sorted((str(d), len(s), str(least.get(root(i)) if s else d)) for i, ((d, _), s) in enumerate(zip(rows, sets)))


@pytest.mark.parametrize(("percent", "n", "few", "block"), [(90, 3, 16, 1 << 18), (80, 5, 2, 600), (80, 2, 1, 300)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, percent, n, few, block):
    monkeypatch.setattr(ngram_join, "FEW", few)
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", block)
    rng = np.random.default_rng(percent + n)
    w = [f"v{i}" for i in range(3000)]
    rows = []
    for g in range(12):
        base = rng.choice(w, int(rng.integers(2, 120))).tolist()
        for _ in range([1, 2, 5, 40][g % 4]):
            t = list(base)
            for _ in range(int(rng.integers(0, 4))):
                t[int(rng.integers(len(t)))] = str(rng.choice(w))
            rows.append((len(rows), " ".join(t) if rng.random() < 0.9 else " ".join(t).upper()))
    common = " ".join(rng.choice(w, 60))
    rows += [(len(rows) + i, f"{common} {' '.join(rng.choice(w, 40))}") for i in range(30)]
    rows += [(900, None), (901, ""), (902, "  "), (903, "solo"), (904, "SOLO"), (905, "two words"), (5, rows[5][1]), (3, "other text for a used id"), (None, "solo"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = ngram_join.near_duplicate_components(df, percent, n).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == components_brute(rows, percent, n)


def test_blocks_of_short_texts_are_bounded_by_rows(spark):
    member = spark.range(30_000).selectExpr("id AS v", "6L AS n", "1L AS component")
    tasks = ngram_join.in_blocks(member).groupBy("i", "j").count().collect()
    assert len({r["i"] for r in tasks}) >= 15 and max(r["count"] for r in tasks) < 2 * 2300
    blocks = ngram_join.in_blocks(member).select("v", "block", "i", "j")
    assert blocks.groupBy("v").count().agg(F.min("count"), F.max("count")).first()[:] == (15, 15)


def test_a_block_of_short_texts_is_compared_in_strips():
    import tracemalloc

    import pandas as pd

    rows = 4096
    pdf = pd.DataFrame({"v": range(rows), "block": np.arange(rows) % 2, "shingles": [np.arange(10) + 100 * (i // 64) for i in range(rows)]})
    tracemalloc.start()
    got = ngram_join.block_links(80)((1, 0, 1), pdf)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == rows - rows // 64 and peak < 150e6, peak


@pytest.mark.parametrize("rows", [7, 2048])
def test_short_templates_equal_brute_force(spark, monkeypatch, rows):
    monkeypatch.setattr(ngram_join, "FEW", 2)
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", rows)
    monkeypatch.setattr(ngram_join, "STRIP", 3)
    docs = [(i, f"a b c d e f g h i j k l m n o p q r s {i % 20} t{i // 30}") for i in range(60)]
    got = ngram_join.near_duplicate_components(spark.createDataFrame(docs, "doc_id long, text string"), 80, 3).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == components_brute(docs, 80, 3)


def test_near_duplicates_of_messy_tables(messy, empty):
    assert ngram_join.near_duplicate_components(messy).count() == 11
    assert ngram_join.near_duplicate_components(empty).count() == 0


def test_shingle_pieces_equal_the_whole(monkeypatch):
    import pyarrow as pa

    column = pa.array([LONG[:4000], None, "", "a b", "Ab c d e"] * 3).slice(1, 12)
    whole = [s.tolist() for _, part in shingles.sets_of(column) for s in part]
    monkeypatch.setattr(shingles, "PIECE", 64)
    assert whole == [s.tolist() for _, part in shingles.sets_of(column) for s in part]
    assert len({s[0] for s in whole if len(s) == 1}) == 1


def test_columns_named_like_the_results_give_way(spark, messy):
    """Each operator's own columns win, once; all other extra columns stay."""
    names = "n_words log_prob word_log_prob rest n_hit items n_lines n_dropped kept_text lang_pred lang_score toxic_score toxic_flag piece_ids n_pieces ids_crc32 round_trip".split()
    docs = messy.select("doc_id", "text", *[F.lit("theirs").alias(n) for n in names])
    words = masked_lm.vocabulary(docs)
    own = {
        "n_words log_prob word_log_prob": masked_lm.score_words(docs, masked_lm.train(docs, words=words), words),
        "n_lines n_dropped kept_text": line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs)),
        "lang_pred lang_score": lang_id.predict(docs, *lang_id.train(docs.withColumn("lang", F.lit("en")))),
        "n_words n_hit items": decontamination.decontaminate(docs, docs.select(F.lit(1).alias("item_id"), "text")),
        "piece_ids n_pieces round_trip": spv.encode(docs, PIECES),
    }
    for new, out in own.items():
        assert len(set(out.columns)) == len(out.columns), new
        rows = out.collect()
        assert len(rows) == messy.count()
        for name in set(names) & set(out.columns):
            assert all((r[name] == "theirs") == (name not in new.split()) for r in rows), (new, name)


def test_rounds_of_training_leave_no_shuffle_files(spark, data):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = [files.apply(i).getName() for i in range(files.size())]
        return {n for n in names if n.startswith("shuffle_")}

    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    words = masked_lm.materialize(masked_lm.vocabulary(docs), "word-counts")
    masked_lm.class_totals(words)
    before = shuffled()
    masked_lm.train(docs, words=words)
    left = {n.split("_")[1] for n in shuffled() - before}
    assert len(left) <= 1  # of the totals of the classes; rounds used to leave theirs


def test_workers_give_large_blocks_back():
    import resource

    from clearset.llm.text import give_back

    def resident():
        return int(open("/proc/self/statm").read().split()[1]) * resource.getpagesize()

    give_back()
    before = resident()
    for _ in range(3):  # freeing a block of this size would raise glibc's bounds to it
        np.ones(24 << 20, np.uint8)
    kept = [np.ones(16 << 20, np.uint8) for _ in range(8)]
    last = bytearray(b"x" * 100_000)
    del kept
    assert resident() - before < 24 << 20 and last


def test_threshold_of_frequent_shingles_is_exact_and_changes_no_component(spark, monkeypatch):
    from clearset.llm import ngram_join

    counts = lambda *n: spark.createDataFrame([(i, x) for i, x in enumerate(n)], "shingle long, n long")
    many = counts(*[17] * 10, *[20] * 5, *[5000] * 3)
    assert ngram_join.threshold(many) == ngram_join.threshold(many.limit(0)) == ngram_join.FEW
    monkeypatch.setattr(ngram_join, "FREQUENT", 5)
    assert ngram_join.threshold(many) == 20  # three exceed it, eight exceed 19; rows / FREQUENT would be 3,054
    monkeypatch.setattr(ngram_join, "FREQUENT", 2)
    assert ngram_join.threshold(many) == 7500
    words = [f"w{k}" for k in range(30)]
    texts = [" ".join([*words[: 20 + i % 3], f"own{i // 4}"]) for i in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    few = {r["doc_id"]: r["component_id"] for r in ngram_join.near_duplicate_components(docs, 90, 3).collect()}
    sets = [{tuple(t.split()[p : p + 3]) for p in range(len(t.split()) - 2)} for t in texts]
    parent = list(range(120))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(120):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    assert few == {i: root(i) for i in range(120)}
