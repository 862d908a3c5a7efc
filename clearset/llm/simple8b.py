"""Simple-8b: word-aligned coding of unsigned integers.

Each 64-bit word holds a 4-bit selector and as many equally wide values as fit into the
other 60 bits.  Selector 0 is an escape: the next word holds one raw 64-bit value (of 2^60
or more).  Values are coded in blocks of ``BLOCK``; each block begins with a new word, and
the offsets of the blocks let a decoder work on all words at once, or on one block alone.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1024
ESCAPE = 0
#: Fixed values of the format: how many values of how many bits each selector packs.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
_GAP = 64  # zeros after each block, so that a window never reaches the next one


#: Narrowest selector width of each value below 2^16, as the number of widths that are too narrow.
_NARROW = np.searchsorted(BITS[1:], np.ceil(np.log2(np.arange(1 << 16) + 1)).astype(int)).astype(np.uint8)


def _widths(values: np.ndarray) -> np.ndarray:
    """For each value the number of selector widths that are too narrow; 14 means an escape."""
    if values.max() < len(_NARROW):
        return _NARROW[values]
    out = np.zeros(values.shape, np.uint8)
    for b in BITS[1:]:
        out += values >= np.uint64(1) << np.uint64(b)
    return out


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, block offsets): offsets[i] is the first word of block i; its last entry is the
    number of words."""
    values = np.asarray(values, np.uint64)
    n = len(values)
    blocks = -(-n // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint32)
    stride = BLOCK + _GAP
    grid = np.zeros((blocks, stride), np.uint64 if values.max() >> np.uint64(32) else np.uint32)
    full = n // BLOCK
    grid[:full, :BLOCK] = values[: full * BLOCK].reshape(full, BLOCK)
    if full < blocks:
        grid[full, : n - full * BLOCK] = values[full * BLOCK :]
    flat = grid.reshape(-1)
    width = _widths(flat)
    # widest value of the windows that start at each place, by doubling
    widest = {1: width}

    def window(c: int) -> np.ndarray:
        if c not in widest:
            half = max(k for k in widest if k < c)
            a = widest[half] if 2 * half >= c else window(-(-c // 2))
            half = half if 2 * half >= c else -(-c // 2)
            shift = c - half
            out = a.copy()
            np.maximum(a[:-shift], a[shift:], out=out[:-shift])
            widest[c] = out
        return widest[c]

    selector = np.full(len(flat), ESCAPE, np.uint8)
    for s in range(len(COUNTS) - 1, 0, -1):  # the most values win
        np.copyto(selector, np.uint8(s), where=window(int(COUNTS[s])) < s)
    step = COUNTS.astype(np.uint8)[selector]
    begins = np.zeros(len(flat), bool)
    at = np.arange(blocks) * stride
    end = at + BLOCK
    end[-1] = at[-1] + n - (blocks - 1) * BLOCK
    while len(at):  # all blocks at once, a word at a time
        begins[at] = True
        at = at + step[at]
        live = at < end
        if not live.all():
            at, end = at[live], end[live]
    at = np.flatnonzero(begins)
    s = selector[at]
    place = np.arange(len(at)) + np.r_[0, np.cumsum(s == ESCAPE)[:-1]]
    words = np.zeros(len(at) + int((s == ESCAPE).sum()), np.uint64)
    for k in np.unique(s):
        own = np.flatnonzero(s == k)
        if k == ESCAPE:
            words[place[own] + 1] = flat[at[own]]
            continue
        word = np.full(len(own), np.uint64(k) << np.uint64(60))
        for j in range(COUNTS[k]):
            word |= flat[at[own] + j].astype(np.uint64) << np.uint64(j * BITS[k])
        words[place[own]] = word
    first = np.searchsorted(at, np.arange(blocks) * stride)
    return words, np.r_[place[first], len(words)].astype(np.uint32)


def decode(words: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values of all blocks."""
    blocks = len(offsets) - 1
    if not blocks:
        return np.zeros(0, np.uint64)
    stride = BLOCK + _GAP
    selector = (words >> np.uint64(60)).astype(np.uint8)
    raw = np.zeros(len(words), bool)
    last = -2
    for i in np.flatnonzero(selector == ESCAPE):
        if i != last + 1:  # else this is the raw value of the word before
            raw[i + 1] = True
            last = i
    count = np.where(raw, 0, COUNTS[np.where(raw, 0, selector)])
    before = np.r_[0, np.cumsum(count)]
    block = np.repeat(np.arange(blocks), np.diff(offsets.astype(np.int64)))
    at = before[:-1] - before[offsets[:-1]][block] + block * stride
    out = np.zeros(blocks * stride, np.uint64)
    for k in np.unique(selector[~raw]):
        own = np.flatnonzero((selector == k) & ~raw)
        if k == ESCAPE:
            out[at[own]] = words[own + 1]
            continue
        mask = np.uint64((1 << int(BITS[k])) - 1)
        for j in range(COUNTS[k]):
            out[at[own] + j] = (words[own] >> np.uint64(j * BITS[k])) & mask
    return out.reshape(blocks, stride)[:, :BLOCK].reshape(-1)[:n]
