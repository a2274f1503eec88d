"""Simple-8b word-aligned coding of unsigned integers, in numpy.

A 64-bit word holds a selector in its top 4 bits and, in the other 60, as many
integers as fit at one bit width. Selector 15 is the escape: the next word is
one integer of up to 64 bits. Values are coded in blocks of ``BLOCK``; offsets
of the blocks are kept, so blocks are coded and decoded side by side.
"""

from __future__ import annotations

import numpy as np

#: Integers per word and bits of each, by selector 0 to 13.
COUNTS = (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = 15

BLOCK = 4096  # below 2**15, so that counts within a block fit 16 bits

#: Smallest selector whose width holds a value, by the value's bit length.
NEEDED = np.array([next((s for s, w in enumerate(WIDTHS) if w >= bits), ESCAPE) for bits in range(66)], np.uint8)


def encode(values: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Words, and the index of the first word of each block (one more entry
    marks the end). Each word takes as many values as fit from where it starts;
    the last word of a block is padded with zeros."""
    v = np.asarray(values, np.uint64)
    n = len(v)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    rows = -(-n // block)
    ends = np.minimum(np.arange(block, rows * block + block, block), n)
    # selector each value needs, one row per block; zeros behind a block fit any.
    # A float may round up to the next power of two: a wider word, never a narrower one.
    need = np.zeros(rows * block, np.uint8)
    need[:n] = NEEDED[np.frexp(v.astype(np.float64))[1]]
    grid = np.zeros((rows, block + COUNTS[0]), np.uint8)
    grid[:, :block] = need.reshape(rows, block)
    best = np.full((rows, block), ESCAPE, np.uint8)  # selector of a word that starts at each value
    for s in range(len(COUNTS) - 1, -1, -1):  # a later, denser one replaces an earlier one
        wide = np.zeros((rows, block + COUNTS[0] + 1), np.int16)
        np.cumsum(grid > s, axis=1, dtype=np.int16, out=wide[:, 1:])
        np.copyto(best, np.uint8(s), where=wide[:, COUNTS[s] : COUNTS[s] + block] == wide[:, :block])
    best = best.reshape(-1)[:n]
    step = np.minimum(np.array(COUNTS + (1, 1), np.int32)[best], np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(n))
    # all blocks walk from word to word together
    here, starts = np.concatenate([[0], ends[:-1]]), []
    live = np.arange(len(ends))
    while len(live):
        starts.append(np.stack([live, here]))
        here = here + step[here]
        go = here < ends[live]
        live, here = live[go], here[go]
    starts = np.concatenate(starts, axis=1)
    order = np.argsort(starts[1], kind="stable")
    owner, first = starts[0][order], starts[1][order]
    sel = best[first]
    taken = step[first]
    raw = sel == ESCAPE
    place = np.cumsum(1 + raw) - 1 - raw  # word index of each coded group
    words = np.zeros(int((1 + raw).sum()), np.uint64)
    for s in np.unique(sel):
        group = np.flatnonzero(sel == s)
        if s == ESCAPE:
            words[place[group]] = np.uint64(ESCAPE << 60)
            words[place[group] + 1] = v[first[group]]
            continue
        packed = np.full(len(group), int(s) << 60, np.uint64)
        for k in range(COUNTS[s]):
            has = taken[group] > k
            packed[has] |= v[first[group][has] + k] << np.uint64(k * WIDTHS[s])
        words[place[group]] = packed
    offsets = np.concatenate([place[np.searchsorted(owner, np.arange(len(ends)))], [len(words)]]).astype(np.int64)
    return words, offsets


def decode(words: np.ndarray, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ``n`` values of ``encode``; also of a run of whole blocks, with their
    offsets counted from the run's first word."""
    words = np.asarray(words, np.uint64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    plain = np.ones(len(words), bool)
    esc = np.zeros(len(words), bool)
    if (sel == ESCAPE).any():  # the word behind an escape has no selector of its own
        for i in np.flatnonzero(sel == ESCAPE):
            if plain[i]:
                esc[i] = True
                if i + 1 < len(words):
                    plain[i + 1] = False
    counts = np.where(esc, 1, np.array(COUNTS + (1, 1))[sel]) * plain
    sizes = np.full(len(offsets) - 1, block)
    if len(sizes):
        sizes[-1] = n - block * (len(sizes) - 1)
    # the last word of a block may hold fewer values than its selector says
    before = np.concatenate([[0], np.cumsum(counts)])
    over = before[offsets[1:]] - before[offsets[:-1]] - sizes
    last = offsets[1:] - 1
    last = np.where(plain[last], last, last - 1) if len(last) else last
    real = counts.copy()
    real[last] -= over
    start = np.concatenate([[0], np.cumsum(real)])[:-1]
    out = np.zeros(n, np.uint64)
    for s in np.unique(sel[plain]) if len(words) else ():
        group = np.flatnonzero((sel == s) & plain)
        if s == ESCAPE:
            out[start[group]] = words[group + 1]
            continue
        mask = np.uint64((1 << WIDTHS[s]) - 1)
        for k in range(COUNTS[s]):
            has = group[real[group] > k]
            out[start[has] + k] = (words[has] >> np.uint64(k * WIDTHS[s])) & mask
    return out
