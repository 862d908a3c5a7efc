"""The pipeline against plain Python versions of its stages, each on its own input."""

import re

import pytest

pytest.importorskip("public_tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tests.llm.test_llm_edges import components_brute, hits_brute, lines_brute  # noqa: E402


def test_stages_against_brute_force(spark, data, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(150)
    extra = spark.createDataFrame([(9001, None, "en", "x", None), (9002, "123 456", "en", "x", 7), (9003, "", None, "x", 0)], docs.schema)
    docs = docs.unionByName(extra)
    docs.write.parquet(str(tmp_path / "0"))
    docs = spark.read.parquet(str(tmp_path / "0"))
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{data}/benchmark.parquet").collect()]
    columns = docs.columns
    before = {r["doc_id"]: r for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, data).write.parquet(str(tmp_path / str(k + 1)))
        docs = spark.read.parquet(str(tmp_path / str(k + 1)))
        after = {r["doc_id"]: r for r in docs.collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        if name == "language_id":
            assert set(before) - set(after) == {9001, 9002, 9003}
        elif name == "line_dedup":
            want = lines_brute([(i, r["text"]) for i, r in before.items()])
            assert {i: r["text"] for i, r in after.items()} == {i: t for (i, _), t in want.items()}
        elif name == "near_duplicates":
            rows = [(i, r["text"]) for i, r in before.items()]
            assert set(after) == {int(d) for d, _, c in components_brute(rows, 80, 5) if d == c}
        elif name == "benchmark_decontamination":
            assert set(after) == {i for i, r in before.items() if not hits_brute(r["text"], items)[1]}
        else:
            assert set(after) == set(before) and all(r["round_trip"] and r["n_pieces"] == len(r["piece_ids"]) for r in after.values())
        before = after
    assert re.match("piece_ids", docs.columns[3])


def test_run(spark, data):
    assert corpus_pipeline.run(spark, data).count() > 0


def test_large_groups_of_copies_keep_one(spark, data):
    texts = {i: "first line of a text\nits second line\nfirst line of a text" for i in range(5, 30)}
    texts |= {100 + i: f"a long line that near copies share\nanother such line\nown {i}" for i in range(12)}
    texts |= {200 + i: f"boilerplate\nwords of document {i} which are many more than that" for i in range(11)}
    docs = spark.createDataFrame([(i, t, "en", "x", len(t)) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long")
    lined = corpus_pipeline.line_dedup_stage(spark, docs, data)
    got = {r["doc_id"]: r["text"] for r in lined.collect()}
    want = {5: texts[5], 100: texts[100]} | {100 + i: f"own {i}" for i in range(1, 12)} | {i: t.split("\n")[1] for i, t in texts.items() if i >= 200}
    assert got == want
    assert all(r["n_chars"] == len(r["text"]) for r in lined.collect())
    assert 5 in {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, lined, data).collect()}


def test_piece_ids_are_those_of_the_library(spark, data):
    import public_tokenizers
    import sentencepiece

    docs = spark.read.parquet(f"{data}/documents.parquet").limit(40)
    whole = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(r["piece_ids"] == whole.encode(texts[r["doc_id"]]) for r in corpus_pipeline.sentencepiece(spark, docs, data).collect())


def test_piece_ids_come_from_the_stream(spark, data, monkeypatch):
    from clearset.llm import sentencepiece_viterbi as spv
    import public_tokenizers

    v = spv.load_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    texts = ["aaaaaaaaaaaa  two  spaces ", "a\nline\tand a tab\r\n", "日本 \u2581mark 🙂🙂 naïve", "x" * 100, " ", "\u2581", "", "unbelievablenesses " * 9]
    texts += [r["text"] for r in spark.read.parquet(f"{data}/documents.parquet").limit(60).collect()]
    found, want = spv.encode_batch(v, texts, "pairs"), spv.encode_batch(v, texts, "merges")
    assert all((a == b).all() for a, b in zip(found, want))
    monkeypatch.setattr(v, "words_apart", False)  # whole texts, with commits
    whole = spv.encode_batch(v, texts[:20], "pairs")
    assert (whole[1] == want[1][:20]).all() and (whole[0] == want[0][: len(whole[0])]).all()
    stream = spv.PairedViterbi(v)
    stream.feed(spv.MARK + "someverylongword" * 500)
    assert stream.most_kept < 1000 and stream.finish() == spv.merge_words(v, [spv.MARK + "someverylongword" * 500])[0].tolist()
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(5)
    got = {}
    monkeypatch.setattr(spv, "encode", lambda *a, **k: got.update(k) or docs.selectExpr("doc_id", "lang", "source", "array(1) AS piece_ids", "true AS round_trip"))
    corpus_pipeline.sentencepiece(spark, docs, data)
    assert got["search"] == "pairs"


def test_near_duplicates_go_by_row(spark, data):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    rows = [(1, a), (3, a + " end"), (3, "a clean text under an id that repeats"), (3, b), (7, b), (3, b + " end"), (5, c), (5, c), (5, c), (None, "text without any id at all"), (None, "text without any id at all"), (None, a), (9, None), (9, "")]
    docs = spark.createDataFrame([(i, t, "en", f"s{k}", k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_duplicates(spark, docs, data)
    assert out.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    own = [r for r in got if r[0] == 3 and r[1].startswith("b")]
    assert len(own) == 1
    assert got == sorted([(1, a), (3, rows[2][1]), own[0], (5, c), rows[9], (9, None), (9, "")], key=str)


def test_stages_keep_clashing_columns_and_take_empty_tables(spark, data):
    item = spark.read.parquet(f"{data}/benchmark.parquet").first()["text"]
    texts = ["a text of its own with words\nand a second line", None, "", "1 2 3", item, "a text of its own with words\nand a second line"]
    names = ["rk", "doc", "lang_pred", "lang_score", "n_lines", "n_dropped", "kept_text", "component", "n_hit", "row"]
    rows = [(i % 4 or None, t, "en" if i % 2 else None, "s", 1, *[f"{n}{i}" for n in names]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {', '.join(f'{n} string' for n in names)}")
    kept = {"language_id": [0, 4, 5], "line_dedup": range(6), "near_duplicates": [1, 2, 3, 4, 5], "benchmark_decontamination": [0, 1, 2, 3, 5]}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, data)
        assert out.columns == docs.columns and stage(spark, docs.limit(0), data).count() == 0
        got = sorted(out.collect(), key=lambda r: r["rk"])
        assert [r["rk"] for r in got] == [f"rk{i}" for i in kept[name]], name
        assert all(r[n] == f"{n}{r['rk'][2:]}" for r in got for n in names)
        assert name != "language_id" or all(r["lang"] for r in got)


def test_lines_of_repeated_ids_count_once(spark):
    from clearset.llm import line_dedup

    rows = [(i, f"shared\nown {i}") for i in range(9)] + [(8, "shared\nanother text"), (None, "shared\nno id"), (None, "shared\nno id")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert line_dedup.keep_bitmaps(df).count() == 0
    more = line_dedup.apply_bitmaps(df.unionByName(df.limit(1).selectExpr("99L AS doc_id", "text")), line_dedup.keep_bitmaps(df.unionByName(df.limit(1).selectExpr("99L AS doc_id", "text"))))
    assert [r["n_dropped"] for r in more.collect()] == [1] * 13
