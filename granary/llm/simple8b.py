"""Simple-8b word-aligned coding of token ids, in blocks that decode on their own.

A 64-bit word has a selector in its top 4 bits and 60 bits of ids. Selectors 0 to 14 pack
COUNTS[s] ids of WIDTHS[s] bits each, from the lowest bits up; with selector ESCAPE the 60 bits
are one id of any size below 2**60. Every word takes as many ids as fit, and a word may promise
more ids than its block has left: the rest is zeros. All blocks of a call are packed together,
one word of each at a time, and decoded together by one gather.
"""

from __future__ import annotations

import numpy as np

COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
ESCAPE = 15
BLOCK = 1024


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits needed for each value below 2**60."""
    if int(values.max()) >> 53 == 0:
        return np.frexp(values.astype(np.float64))[1]
    out = np.zeros(len(values), np.int64)
    some = values > 0
    out[some] = np.frexp(values[some].astype(np.float64))[1]
    # a float of 53 bits may round up to the next power of two
    high = some & (out > 0)
    out[high] -= (np.uint64(1) << (out[high] - 1).astype(np.uint64)) > values[high]
    return out


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of all ids, and the first word of every block of BLOCK ids."""
    values = np.ascontiguousarray(ids, np.uint64)
    n = len(values)
    if n == 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    if int(values.max()) >> 60:
        raise ValueError("an id has more than 60 bits")
    blocks = -(-n // BLOCK)
    # behind its last id a block has ids of no bits, as a word may promise more than there are
    widest = np.zeros((blocks, BLOCK + int(COUNTS[0])), np.uint8)
    width = np.zeros(blocks * BLOCK, np.uint8)
    width[:n] = _bits(values)
    widest[:, :BLOCK] = width.reshape(blocks, BLOCK)
    selector, cover = np.full((blocks, BLOCK), ESCAPE, np.int8), 1
    for s in range(ESCAPE - 1, -1, -1):  # where more ids fit, fewer do as well
        step = int(COUNTS[s]) - cover  # at most what is covered
        widest, cover = np.maximum(widest[:, :-step], widest[:, step:]), int(COUNTS[s])
        fits = widest[:, :BLOCK] <= WIDTHS[s]
        if not fits.any():
            break
        selector -= fits.view(np.int8)
    selector = selector.reshape(-1)
    done = blocks * BLOCK
    follows = np.arange(done) + COUNTS[selector]
    ends = np.minimum(np.arange(1, blocks + 1) * BLOCK, n)
    follows = np.append(np.where(follows < np.repeat(ends, BLOCK), follows, done), done)
    at = np.arange(blocks) * BLOCK
    starts = []
    while (at < done).any():
        starts.append(at)
        at = follows[at]
    start = np.stack(starts, axis=1).reshape(-1)
    start = start[start < done]
    chosen, taken = selector[start].astype(np.int64), np.diff(np.append(start, n))
    shift = (np.arange(n) - np.repeat(start, taken)) * np.repeat(WIDTHS[chosen], taken)
    words = (chosen.astype(np.uint64) << np.uint64(60)) | np.bitwise_or.reduceat(values << shift.astype(np.uint64), start)
    return words, np.searchsorted(start, np.arange(blocks) * BLOCK).astype(np.int64)


def unpack(words: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """The n ids of consecutive whole blocks; ``first`` is the first word of every block."""
    if n == 0:
        return np.empty(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    count = COUNTS[selector]
    # the last word of a block may promise more than the block has
    blocks = len(first)
    sizes = np.full(blocks, BLOCK, np.int64)
    sizes[-1] = n - BLOCK * (blocks - 1)
    last = np.concatenate([first[1:], [len(words)]]) - 1
    total = np.add.reduceat(count, first)
    count[last] -= total - sizes
    ends = np.cumsum(count)
    place = np.arange(n) - np.repeat(ends - count, count)
    wide = WIDTHS[selector]
    mask = (np.uint64(1) << wide.astype(np.uint64)) - np.uint64(1)
    shift = (place * np.repeat(wide, count)).astype(np.uint64)
    shift[np.repeat(wide == 0, count)] = 0
    return (np.repeat(words, count) >> shift) & np.repeat(mask, count)
