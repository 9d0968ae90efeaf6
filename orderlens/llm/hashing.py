"""Vectorised words and word n-grams of Arrow text columns (NumPy, inside tasks)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Text bytes that are worked on at once; a longer text is a group of its own.
CHUNK_BYTES = 1 << 21

U64 = np.uint64


def separator_table(separators: bytes = b"\x20\x09\x0a\x0b\x0c\x0d") -> np.ndarray:
    lut = np.zeros(256, bool)
    lut[np.frombuffer(separators, np.uint8)] = True
    return lut


def text_groups(column: pa.Array, limit: int = CHUNK_BYTES):
    """Yields (first row, bytes, offsets) of runs of rows of at most ``limit`` bytes or one row; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def word_spans(data: np.ndarray, offsets: np.ndarray, lut: np.ndarray):
    """(starts, ends, first): byte spans of all words, and the index of each row's first word."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~lut[data]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    begin[edge] = inside[edge]
    stop[edge - 1] = inside[edge - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on 64-bit words (the public murmur3 constants)."""
    x = x ^ (x >> U64(33))
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], U64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word, eight bytes at a time."""
    if not len(starts):
        return np.zeros(0, U64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))
    length = ends - starts
    h = length.astype(U64) * U64(0x9E3779B97F4A7C15)
    at, todo = starts.copy(), np.arange(len(starts))
    left = length.copy()
    while len(todo):
        block = eight[at] & _MASKS[np.minimum(left, 8)]
        h[todo] = mix64(h[todo] ^ block)
        more = left > 8
        todo, at, left = todo[more], at[more] + 8, left[more] - 8
    return h


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each position (the last n - 1 positions have none)."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, U64)
    total = np.zeros(m, U64)
    factor = 0x9E3779B97F4A7C15
    for j in range(n):
        total = total * U64(factor | 1) + words[j:j + m]
        factor = (factor * 0xD1342543DE82EF95 + 2) & (2**64 - 1)
    return mix64(total)


def row_grams(words: np.ndarray, first: np.ndarray, n: int):
    """(hashes, first): n-grams of every row; a row of fewer than ``n`` words, but one, has one gram of them all."""
    count = np.diff(first)
    grams = gram_hashes(words, n)
    size = np.where(count >= n, count - n + 1, np.minimum(count, 1))
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(at[-1], U64)
    long_rows = np.flatnonzero(count >= n)
    if len(long_rows):
        reps = size[long_rows]
        step = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps)
        out[np.repeat(at[long_rows], reps) + step] = grams[np.repeat(first[long_rows], reps) + step]
    for r in np.flatnonzero((count > 0) & (count < n)):
        out[at[r]] = gram_hashes(words[first[r]:first[r + 1]], int(count[r]))[0]
    return out, at
