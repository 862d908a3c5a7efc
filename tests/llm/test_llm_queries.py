"""The registered queries against DuckDB or a brute-force version, over whole tables."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

public_tokenizers = pytest.importorskip("public_tokenizers")

from clearset.llm import masked_lm, queries, sentencepiece_viterbi as spv  # noqa: E402


@pytest.fixture(scope="module")
def docs(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet").toPandas().sort_values("doc_id", ignore_index=True)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_twin(spark, data, duck, same, name):
    same(queries.QUERIES[name](spark, data).toPandas(), duck.execute(queries.SQL[name]).df())


def test_op1_equals_the_tokenizer(spark, data, docs):
    got = queries.QUERIES["op1_token_files"](spark, data).toPandas().sort_values("doc_id")
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, want = 0, []
    for e in t.encode_batch(docs["text"].tolist(), add_special_tokens=False):
        ids = np.array([*e.ids, 0], "<u4")
        want.append((start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert list(got[["start", "n_tokens", "ids_crc32"]].itertuples(index=False, name=None)) == want


def test_op3_recall_and_scores(spark, data):
    got = queries.QUERIES["op3_graph_ann"](spark, data).toPandas()
    e = spark.read.parquet(f"{data}/embeddings.parquet").toPandas()
    x, ids = np.stack(e["embedding"]).astype(float), e["vec_id"].to_numpy()
    hits = 0
    for q in ids[ids % 20 == 0]:
        s = x @ x[ids == q][0]
        own = got[got["query_id"] == q].sort_values("rank")
        near = [i for i in ids[np.lexsort((ids, -s))] if i != q][:20]
        hits += len(set(near) & set(own["vec_id"]))
        assert own["rank"].tolist() == list(range(1, 21)) and own["score"].is_monotonic_decreasing
        assert np.allclose(own["score"], [s[ids == i][0] for i in own["vec_id"]], atol=1e-12)
    assert hits / (20 * (ids % 20 == 0).sum()) >= 0.9


def test_op4_beats_a_uniform_guess_everywhere_it_should(spark, data, docs):
    got = queries.QUERIES["op4_masked_lm"](spark, data).toPandas()
    assert len(got) == len(docs) and (got["log_prob"] < 0).all()
    assert got["log_prob"].sum() / got["n_words"].sum() > -np.log(masked_lm.CLASSES) + 0.5


def test_op6_held_out_accuracy(spark, data, docs):
    got = queries.QUERIES["op6_language_id"](spark, data).toPandas().merge(docs[["doc_id", "lang"]], on="doc_id")
    own = got[got["held_out"]]
    assert own["score"].between(0, 1).all() and (own["lang_pred"] == own["lang"]).mean() >= 0.97
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got["doc_id"]]).all()


def test_op7_shape(spark, data, docs):
    got = queries.QUERIES["op7_toxicity"](spark, data).toPandas()
    assert len(got) == len(docs) and got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= 0.3)).all()


def test_op9_equals_an_unbounded_search(spark, data, docs):
    got = queries.QUERIES["op9_sentencepiece"](spark, data).toPandas().set_index("doc_id")
    assert got["round_trip"].all()
    v = spv.load_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    for row in docs[docs["n_chars"] < 900].head(25).itertuples():
        text = spv.MARK + row.text.replace(" ", spv.MARK)
        best = [(0.0, 0, -1)] + [(-np.inf, 0, -1)] * len(text)  # (score, length of the last piece, its id)
        for end in range(1, len(text) + 1):
            tries = [(best[end - k][0] + v.scores[v.ids[text[end - k : end]]], k, v.ids[text[end - k : end]]) for k in range(1, min(v.longest, end) + 1) if text[end - k : end] in v.ids]
            if text[end - 1] not in v.ids:
                tries.append((best[end - 1][0] + v.unknown, 1, -1))
            best[end] = max(tries, key=lambda t: (t[0], t[1]))
        ids, at = [], len(text)
        while at:
            _, k, i = best[at]
            ids[:0] = [i] if i >= 0 else spv.unknown_ids(v, text[at - 1])
            at -= k
        assert got.loc[row.doc_id, "ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
