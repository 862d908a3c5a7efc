"""Periodic runs in texts: stretches of words that repeat themselves several times in a row.

A block of texts (an Arrow batch) becomes one sequence of word numbers in which no two texts share
a number, so that repeats never cross texts.  Its suffixes are sorted by doubling.  A first pass
over groups of ``LEAST_COMMON`` words settles texts that repeat none: a run of ``least`` words and
``exponent`` periods repeats at least so many words one period on.  The others get suffix array
and LCP, from these the longest-previous-factor array (LPF), and from it their LZ blocks.  A run
then either touches a boundary between two blocks, where Main's extensions to both sides find it
(common prefixes and suffixes come from the ranks of the doubling), or lies inside a block and is
a copy of a run further left: buckets of runs by their start are read off at the block's source.

Runs here are maximal: a period q is the smallest one of the stretch, words q apart are equal, and
no neighbouring word can be added.

Defined cases: a null or empty text has no words, no runs and an empty collapsed text; texts of
any length are one sequence, never cut; rows that repeat a doc_id are texts of their own; an
empty table gives an empty result; extra columns stay, but columns named runs or collapsed give
way to the operator's own.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearset.llm.numbering import Numbers
from clearset.llm.text import small_batches, words_between_spaces

#: Shortest run in words and in periods.
LEAST, EXPONENT = 6, 4


class Runs(NamedTuple):
    """Start, end (exclusive) and period of runs, by start and then period."""

    start: np.ndarray
    end: np.ndarray
    period: np.ndarray


def _repeats(ids: np.ndarray, sizes: np.ndarray, words: int) -> np.ndarray:
    """Which texts may hold the same group of ``words`` words twice (by 64-bit hash: a text that
    does is always among them)."""
    n = len(ids) - words + 1
    if n <= 0:
        return np.zeros(len(sizes), bool)
    h = np.zeros(n, np.uint64)
    for k in range(words):  # unsigned products wrap around
        h = (h ^ ids[k : k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    ordered = np.sort(h)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    hit = np.flatnonzero(np.isin(h, twice))
    return np.bincount(np.repeat(np.arange(len(sizes)), sizes)[hit], minlength=len(sizes)) > 0


class Suffixes:
    """Ranks of the groups of 1, 2, 4, ... items at each position, until all of them differ."""

    def __init__(self, ids: np.ndarray):
        n = len(ids)
        self.ranks = [np.unique(ids, return_inverse=True)[1]]
        width = 1
        while self.ranks[-1].max(initial=-1) + 1 < n:
            r = self.ranks[-1]
            behind = np.zeros(n, np.int64)
            behind[: n - width] = r[width:] + 1
            self.ranks.append(np.unique(r * (n + 1) + behind, return_inverse=True)[1])
            width *= 2
        self.sa = np.argsort(self.ranks[-1])

    def common_prefix(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many items agree from the different positions i and j on."""
        n, out = len(self.sa), np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.ranks))):
            a, b = i + out, j + out
            live = np.flatnonzero(np.maximum(a, b) < n)
            live = live[self.ranks[k][a[live]] == self.ranks[k][b[live]]]
            out[live] += 1 << k
        return out

    def common_suffix(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many items agree from the different positions i and j backwards, both included."""
        out = np.zeros(len(i), np.int64)
        for k in reversed(range(len(self.ranks))):
            a, b = i - out - (1 << k) + 1, j - out - (1 << k) + 1
            live = np.flatnonzero(np.minimum(a, b) >= 0)
            live = live[self.ranks[k][a[live]] == self.ranks[k][b[live]]]
            out[live] += 1 << k
        return out


def longest_previous_factors(sa: list[int], lcp: list[int]) -> tuple[list[int], list[int]]:
    """(lpf, source): the length of the longest stretch from each position on that also starts
    further left, and where it starts there (-1: nowhere)."""
    lpf, source = [0] * len(sa), [-1] * len(sa)
    open_, shared = [], []  # positions that wait for a smaller one behind them in sa, and their lcp with the one before
    for at, common in zip([*sa, -1], [*lcp, 0]):
        while open_ and open_[-1] > at:
            p, left = open_.pop(), shared.pop()
            if left >= common:
                lpf[p], source[p] = left, open_[-1] if open_ and left else -1
            else:
                lpf[p], source[p] = common, at
            common = min(common, left)
        open_.append(at)
        shared.append(common)
    return lpf, source


def lz_blocks(lpf: list[int]) -> list[int]:
    """Starts of the LZ blocks: each is the longest previous factor, or one new item."""
    starts, at = [], 0
    while at < len(lpf):
        starts.append(at)
        at += max(1, lpf[at])
    return starts


def _touching(s: Suffixes, starts: np.ndarray, n: int, least: int, exponent: int) -> Runs:
    """Runs that cross or touch a boundary between LZ blocks, from the longest extensions to both
    sides of it.

    A run of period q that ends in a block starts less than q before the block in front of it:
    otherwise that block, copied from q further left, would reach the run's end.  So q is less
    than the lengths of both blocks over ``exponent`` - 1.
    """
    edges = np.r_[starts, n]
    sizes = np.diff(edges)
    before, own = np.r_[0, sizes], np.r_[sizes, 0]
    most = np.minimum((before + own) // (exponent - 1), n)
    b = np.repeat(edges, most)
    q = np.arange(len(b)) - np.repeat(np.cumsum(most) - most, most) + 1
    found = []
    for shift in (0, q):  # the period before the boundary, or the one behind it
        i, j = b - q + shift, b + shift  # first items behind the boundary, a period apart
        ok = np.flatnonzero((i >= 0) & (j <= n))
        i, j, p = i[ok], j[ok], q[ok]
        right = s.common_prefix(i, j)
        some = np.flatnonzero((right > 0) | (i > 0))
        i, j, p, right = i[some], j[some], p[some], right[some]
        left = s.common_suffix(i - 1, j - 1)
        long = left + right + p >= np.maximum(least, exponent * p)
        found.append((i[long] - left[long], j[long] + right[long], p[long]))
    return Runs(*(np.concatenate(x) for x in zip(*found)))


def runs_of(ids: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> Runs:
    """All runs of a sequence of at least ``least`` items and ``exponent`` (2 or more) periods."""
    n = len(ids)
    if not n:
        return Runs(*(np.zeros(0, np.int64) for _ in range(3)))
    s = Suffixes(ids)
    lcp = np.zeros(n, np.int64)
    lcp[1:] = s.common_prefix(s.sa[:-1], s.sa[1:])
    lpf, source = longest_previous_factors(s.sa.tolist(), lcp.tolist())
    starts = lz_blocks(lpf)
    touching = _touching(s, np.array(starts), n, least, exponent)
    # of equal stretches the smallest period is the run's
    period: dict[tuple[int, int], int] = {}
    for a, e, q in zip(*(x.tolist() for x in touching)):
        period[a, e] = min(q, period.get((a, e), q))
    bucket: dict[int, list[tuple[int, int]]] = {}
    for (a, e), q in period.items():
        bucket.setdefault(a, []).append((e, q))
    if bucket:
        for start, size in zip(starts, np.diff([*starts, n]).tolist()):
            if size < least + 2:
                continue
            shift, last = start - source[start], start + size
            for a in range(start + 1, last - least):  # a run inside the block is a copy
                for e, q in bucket.get(a - shift, ()):
                    if e + shift < last and (a, e + shift) not in period:
                        period[a, e + shift] = q
                        bucket.setdefault(a, []).append((e + shift, q))
    rows = np.array(sorted((a, q, e) for (a, e), q in period.items()), np.int64).reshape(-1, 3)
    return Runs(rows[:, 0], rows[:, 2], rows[:, 1])


def collapse(words: list[bytes], runs: Runs) -> bytes:
    """The words without all but the first period of each run, joined by one space."""
    if not len(runs.start):
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, runs.start + runs.period, 1)
    np.add.at(step, runs.end, -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(step[:-1]) == 0).tolist()])


def runs_of_texts(texts: list[str | None], least: int = LEAST, exponent: int = EXPONENT) -> tuple[list[list[bytes]], list[Runs]]:
    """(words, runs) of each text."""
    words = [(t or "").encode("utf-8", "surrogatepass").split() for t in texts]  # bytes split at space and 9 to 13
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    number = Numbers([])
    ids = np.concatenate([np.zeros(0, np.int64), *(np.fromiter(map(number.__getitem__, own), np.int64, len(own)) for own in words)])
    ids += np.repeat(np.arange(len(words)), sizes) * max(len(number), 1)  # no text shares a number with another
    # a run of period q agrees with itself, q on, in max(least, exponent * q) - q items
    common = min(max(least, exponent * q) - q for q in range(1, least + 1))
    some = _repeats(ids, sizes, common)
    found = runs_of(ids[np.repeat(some, sizes)], least, exponent)
    firsts = np.cumsum(np.where(some, sizes, 0)) - np.where(some, sizes, 0)
    cut = np.searchsorted(found.start, firsts)
    last = np.r_[cut[1:], len(found.start)]
    out = [Runs(found.start[a:b] - f, found.end[a:b] - f, found.period[a:b]) if s else Runs(*(np.zeros(0, np.int64),) * 3) for a, b, f, s in zip(cut, last, firsts, some)]
    return words, out


def find_runs(docs: DataFrame, text: str = "text", least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """``docs`` with runs (array of start, length, period; word numbers from 0) and collapsed (the text
    with each run cut to its first period, words joined by one space)."""
    small_batches(docs.sparkSession)
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def find(column: pa.Array) -> pa.Array:
        words, runs = runs_of_texts(column.to_pylist(), least, exponent)
        sizes = np.cumsum([0, *(len(r.start) for r in runs)])
        start, end, period = (np.concatenate([np.zeros(0, np.int64), *(r[k] for r in runs)]) for k in range(3))
        flat = pa.StructArray.from_arrays([pa.array(start), pa.array(end - start), pa.array(period)], fields=list(run))
        lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), flat)
        short = pa.array([collapse(w, r).decode("utf-8", "replace") for w, r in zip(words, runs)], pa.string())
        return pa.StructArray.from_arrays([lists, short], ["runs", "collapsed"])

    found = F.arrow_udf(find, "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    rest = [c for c in docs.columns if c not in ("runs", "collapsed")]
    return docs.select(*rest, found(text).alias("__found")).select(*rest, "__found.*")


def periodic_tail(doc_id: Column, text: Column) -> Column:
    """The query's own repeats: in a tenth of the documents, by crc32 of the id, the words from one
    place on repeat a period; the others stay as they are."""
    h = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        a = (g % F.size(w)).cast("int")
        rest, times = F.size(w) - a, (3 + g % 8).cast("int")
        period = F.slice(w, a + 1, (1 + F.floor(rest / times)).cast("int"))
        return F.array_join(F.concat(F.slice(w, F.lit(1), a), F.slice(F.flatten(F.array_repeat(period, times)), F.lit(1), rest)), " ")

    # the array is bound once: a lambda's other expressions are evaluated for each element
    tail = F.transform(F.array(words_between_spaces(text)), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(text))
    return F.when(h % 10 == 0, tail[0]).otherwise(text)


def op11_runs(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find_runs(docs.select("doc_id", periodic_tail(F.col("doc_id"), F.col("text")).alias("text"))).drop("text")
    # exponents are compared exactly: a / b > c / d where a * d > c * b
    better = F.aggregate(
        "runs",
        F.expr("named_struct('start', cast(null as bigint), 'length', cast(null as bigint), 'period', cast(null as bigint))"),
        lambda best, r: F.when(best["start"].isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best),
    )
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    d = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), better.alias("best"), digest(listed).alias("runs_sha256"), digest(F.col("collapsed")).alias("collapsed_sha256"))
    return d.select("doc_id", "n_runs", "best.*", F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
