"""Vectorised work on the raw bytes of Arrow strings: slices, words, rolling hashes.

A slice is a run of rows whose texts lie next to each other in one buffer, so
that every function here works on whole arrays of bytes or words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once; a longer single text is a slice of its own.
SLICE_BYTES = 1 << 19

#: U+0009 to U+000D and space part words.
IS_BLANK = np.zeros(256, dtype=bool)
IS_BLANK[[9, 10, 11, 12, 13, 32]] = True

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 5  # 5 modulo 8: small powers less one share few factors of two
_BASE -= (_BASE % 8) - 5
_MASK = (1 << 64) - 1


def _table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, _MASK, 256, dtype=np.uint64)


_BYTE = _table(7)
_INVERSE = pow(_BASE, -1, 1 << 64)


class _Powers:
    """Powers of an odd base modulo 2**64, made longer on demand."""

    def __init__(self, base: int) -> None:
        self.base, self.values = base, np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.values) < n:
            step = _U(pow(self.base, len(self.values), 1 << 64))
            self.values = np.concatenate([self.values, self.values * step])
        return self.values[:n]


_POW, _POW_INV = _Powers(_BASE), _Powers(_INVERSE)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets): offsets has one more entry than rows and starts at 0. Nulls are empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        wide = np.int64
    else:
        column, wide = column.cast(pa.string()), np.int32
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    buffers = column.buffers()
    at = np.frombuffer(buffers[1], dtype=wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        end = max(first + 1, int(np.searchsorted(at, at[first] + limit, side="right")) - 1)
        yield first, end, data[at[first] : at[end]], at[first : end + 1] - at[first]
        first = end


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a slice, and for each row the number of words before it (one more entry than rows)."""
    solid = ~IS_BLANK[data]
    start = solid.copy()
    start[1:] &= ~solid[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    start[inner] = solid[inner]
    end = solid.copy()
    end[:-1] &= start[1:] | ~solid[1:]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def prefix_hash(symbols: np.ndarray) -> np.ndarray:
    """Prefix sums from which span_hash takes the hash of any run of the symbols (64-bit)."""
    out = np.empty(len(symbols) + 1, dtype=np.uint64)
    out[0] = 0
    np.cumsum(symbols * _POW.upto(len(symbols)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of symbols[start:end], the same wherever the run lies."""
    return mix((prefix[ends] - prefix[starts]) * _POW_INV.upto(len(prefix))[starts])


def byte_symbols(data: np.ndarray) -> np.ndarray:
    return _BYTE[data]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(prefix_hash(byte_symbols(data)), starts, ends)


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The words with one space between them."""
    if not len(starts):
        return b""
    sizes = ends - starts
    out = np.full(int(sizes.sum()) + len(starts) - 1, 32, dtype=np.uint8)
    to = np.cumsum(sizes + 1) - sizes - 1
    at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(to, sizes) + at] = data[np.repeat(starts, sizes) + at]
    return out.tobytes()


def covered(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of size places lie in some [start, end)."""
    depth = np.bincount(starts, minlength=size + 1) - np.bincount(ends, minlength=size + 1)
    return np.cumsum(depth[:-1]) > 0
