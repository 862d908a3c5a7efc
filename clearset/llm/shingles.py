"""Sets of word-shingle hashes, from the bytes of Arrow string columns, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_P = 0x9E3779B97F4A7C15
_PINV = pow(_P, -1, 1 << 64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_LOWER += 1
#: Bytes of text that are hashed at once.
PIECE = 1 << 18
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0, base^1, ... modulo 2^64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        with np.errstate(over="ignore"):
            have = np.cumprod(np.r_[np.uint64(1), np.full(max(n, PIECE) + 1, np.uint64(base))])
        if n <= PIECE:
            _powers[base] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs of bytes other than space and 9 to 13, A-Z lower-cased) of the
    texts data[offsets[i]:offsets[i + 1]], and how many words each text has."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    inside = ~_SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before = np.r_[False, inside[:-1]] & ~cut[:-1]
    after = np.r_[inside[1:], False] & ~cut[1:]
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_LOWER[data] * _power(_P, n), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _power(_PINV, n)[starts]
    counts = np.diff(np.searchsorted(starts, offsets))
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F)), counts


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = 3) -> list[np.ndarray]:
    """Sorted distinct hashes of ``words`` consecutive words, or of the whole sequence where a
    text has fewer; empty for a text without words."""
    h, counts = word_hashes(data, offsets)
    factors = [np.uint64(pow(0xE7037ED1A0B428DB, j + 1, 1 << 64)) for j in range(words)]
    grams = np.zeros(max(0, len(h) - words + 1), np.uint64)
    for j, f in enumerate(factors):
        grams += (h[j : j + len(grams)] + np.uint64(j)) * f
    grams = mix(grams)
    out, at = [], 0
    for n in counts.tolist():
        if n >= words:
            out.append(np.unique(grams[at : at + n - words + 1]))
        elif n:
            short = np.uint64(n)
            for j in range(n):
                short = short + (h[at + j] + np.uint64(j)) * factors[j]
            out.append(mix(np.array([short ^ np.uint64(0x5851F42D4C957F2D)])))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def sets_of(column: pa.Array, words: int = 3) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(first row, sets of the rows from there on) of a string column, a piece at a time."""
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
            yield first, shingle_sets(data[own[0] : own[-1]], own - own[0], words)
        first = last


def set_key(own: np.ndarray) -> int:
    """64 bits that stand for a set, as a signed integer."""
    with np.errstate(over="ignore"):
        both = np.array([mix(own).sum(), mix(own + np.uint64(0x2545F4914F6CDD1D)).sum() ^ np.uint64(len(own))])
        return int(mix(both[:1] ^ (both[1:] << np.uint64(1)))[0].astype(np.int64))
