"""Vectorised words and word-shingle hashes of Arrow text columns.

A word hash is a polynomial over mapped bytes modulo 2^64, taken for all words at once from one running sum;
shingle hashes mix the hashes of adjacent words. Two different shingles share a 64-bit hash with
probability about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE = 5
SLICE_BYTES = 1 << 17
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)

_space = np.zeros(256, bool)
_space[[9, 10, 11, 12, 13, 32]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_bytes = mix(np.arange(1, 257, dtype=np.uint64), 7)
_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least n of each."""
    if len(_powers.get("up", ())) < n:
        m = max(n, 2 * SLICE_BYTES)
        inverse = np.uint64(pow(int(_BASE), -1, 2**64))
        for name, base in (("up", _BASE), ("down", inverse)):
            x = np.full(m, base, np.uint64)
            x[0] = 1
            _powers[name] = np.cumprod(x)
    return _powers["up"], _powers["down"]


def text_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows of about SLICE_BYTES, of texts or of bytes; nulls count
    as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string()), "")
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + SLICE_BYTES, "right")) - 1)
        hi = min(hi, len(column))
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words in bytes, and the number of the first word of each row (one more at the end)."""
    word = ~_space[data]
    cut = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.zeros(len(word), bool)
    before[1:] = word[:-1]
    before[cut] = False
    after = np.zeros(len(word), bool)
    after[:-1] = word[1:]
    after[cut - 1] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    up, down = powers(len(data) + 1)
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_bytes[_lower[data] if lower else data] * up[: len(data)], out=run[1:])
    return mix((run[ends] - run[starts]) * down[starts])


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes). A row of fewer words has its whole sequence as one; without words, none."""
    for lo, hi, data, offsets in text_slices(column):
        starts, ends, first = words(data, offsets)
        h = word_hashes(data, starts, ends)
        n = max(0, len(h) - size + 1)
        s = np.zeros(n, np.uint64)
        for k in range(size):
            s = s * _ODD + h[k : k + n]
        s = mix(s, 1)
        for row in range(hi - lo):
            a, b = first[row], first[row + 1]
            if b - a >= size:
                yield lo + row, np.unique(s[a : b - size + 1])
            elif b > a:
                one = np.zeros(1, np.uint64)
                for x in h[a:b]:
                    one = one * _ODD + x
                yield lo + row, mix(one, 2 + int(b - a))
            else:
                yield lo + row, np.zeros(0, np.uint64)
