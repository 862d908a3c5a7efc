"""Periodic runs against a direct scan of every period, and the query against plain Python."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clearset.llm import runs


def plain_runs(w, least=6, exponent=4):
    """(start, period, end) by comparing all words a period apart, smallest periods first."""
    found = {}
    for q in range(1, len(w) // exponent + 1):
        i = q
        while i < len(w):
            a = i
            while i < len(w) and w[i] == w[i - q]:
                i += 1
            if i > a and i - a + q >= max(least, exponent * q):
                found.setdefault((a - q, i), q)
            i += 1
    return sorted((a, q, e) for (a, e), q in found.items())


def listed(r):
    return list(zip(r.start.tolist(), r.period.tolist(), r.end.tolist()))


@pytest.mark.parametrize("least,exponent", [(6, 4), (4, 2), (2, 2), (9, 3)])
@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_random_sequences(letters, least, exponent):
    rng = random.Random(letters * 100 + least)
    for size in [0, 1, 2, 5, 6, 7, 12, 30, 80, 200] * 4:
        w = [rng.randrange(letters) for _ in range(size)]
        assert listed(runs.runs_of(np.array(w, np.int64), least, exponent)) == plain_runs(w, least, exponent)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=7), st.integers(1, 6)), max_size=6), st.sampled_from([(6, 4), (2, 2)]))
def test_repeated_pieces(pieces, bounds):
    w = [x for p, k in pieces for x in p * k]
    assert listed(runs.runs_of(np.array(w, np.int64), *bounds)) == plain_runs(w, *bounds)


def test_runs_of_runs_are_copied():
    inner = ["a"] * 6 + ["b"] + ["x", "y"] * 4
    w = (inner * 5 + ["z"]) * 4 + inner * 3
    number = {x: i for i, x in enumerate(dict.fromkeys(w))}
    assert listed(runs.runs_of(np.array([number[x] for x in w]))) == plain_runs(w)


def test_lpf_against_all_pairs():
    rng = random.Random(3)
    for size in (1, 2, 9, 40):
        w = [rng.randrange(2) for _ in range(size)]
        s = runs.Suffixes(np.array(w))
        lcp = np.r_[0, s.common_prefix(s.sa[:-1], s.sa[1:])]
        lpf, source = runs.longest_previous_factors(s.sa.tolist(), lcp.tolist())
        common = lambda i, j: next((k for k in range(size - j) if w[i + k] != w[j + k]), size - j)
        assert s.sa.tolist() == sorted(range(size), key=lambda i: w[i:])
        assert lpf == [max((common(i, j) for i in range(j)), default=0) for j in range(size)]
        assert all(common(source[j], j) == lpf[j] for j in range(size) if lpf[j])


MESSY = [None, "", " \t\n", "one", "a a a a a a", "A a A a A a A a", "x y x y x y x y", "la la la la la la  end " * 5, "w " * 5, "é è " * 40 + "fin", " ".join(str(i % 999) for i in range(30_000)), "a a a a a a", "p q r " * 4 + "p q"]


def test_texts_share_nothing_and_collapse(spark):
    rows = [(i % 5 if i else None, t, "r", i) for i, t in enumerate(MESSY)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, at int").repartition(3)
    got = runs.find_runs(docs)
    assert got.columns == ["doc_id", "text", "at", "runs", "collapsed"]
    for r in got.collect():
        w = (r.text or "").encode().split()
        want = plain_runs(w)
        assert [(x.start, x.period, x.start + x.length) for x in r.runs] == want, r.at
        gone = {i for a, q, e in want for i in range(a + q, e)}
        assert r.collapsed.encode() == b" ".join(x for i, x in enumerate(w) if i not in gone)
    assert runs.find_runs(docs.where("at < 0")).count() == 0


def test_query_equals_plain_python(spark, data):
    from clearset.llm.runs import op11_runs

    docs = spark.read.parquet(f"{data}/documents.parquet").toPandas()
    got = op11_runs(spark, data).toPandas().set_index("doc_id")
    assert len(got) == len(docs) and (got["n_runs"] > 0).sum() > 5
    for doc_id, text in zip(docs["doc_id"], docs["text"]):
        w = (text or "").encode().split()
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        if len(w) > 900:
            continue
        want = plain_runs(w)
        gone = {i for a, q, e in want for i in range(a + q, e)}
        own = got.loc[doc_id]
        lines = "".join(f"{a},{e - a},{q}\n" for a, q, e in want)
        assert own["n_runs"] == len(want)
        assert own["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert own["collapsed_sha256"] == hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()
        if want:
            a, q, e = max(want, key=lambda r: (Fraction(r[2] - r[0], r[1]), -r[0], -r[1]))
            assert tuple(own[["start", "length", "period", "exponent_milli"]]) == (a, e - a, q, 1000 * (e - a) // q)
        else:
            assert own[["start", "length", "period", "exponent_milli"]].isna().all()
