"""Compressed bitmaps in bulk: sets of small numbers as Arrow binaries, and bit planes beside them.

A set below a span is either the list of its members (two bytes each) or a
bitmap of span bits, whichever is shorter; its length tells which.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column without nulls, and where each value begins (one more entry than rows)."""
    column = column.cast(pa.large_binary())
    buffers = column.buffers()
    at = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, dtype=np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if len(column) and buffers[2] is not None else np.zeros(0, dtype=np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each run, one run after the other."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) - np.repeat(before - starts, sizes)


def pack_sets(members: np.ndarray, sizes: np.ndarray, span: int) -> pa.Array:
    """One binary for each set. members: below span, rising within each set, the sets one after the other; span: a multiple of 8, at most 65,536."""
    dense = 2 * sizes >= span // 8
    width = np.where(dense, span // 8, 2 * sizes)
    ends = np.cumsum(width)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    which = np.repeat(dense, sizes)
    listed = members[~which].astype("<u2").view(np.uint8)
    out[ranges((ends - width)[~dense], width[~dense])] = listed
    if which.any():
        bits = np.zeros(int(dense.sum()) * span, dtype=np.uint8)
        bits[np.repeat(np.arange(int(dense.sum())) * span, sizes[dense]) + members[which]] = 1
        out[ranges((ends - width)[dense], width[dense])] = np.packbits(bits, bitorder="little")
    return _binary(out, ends)


def unpack_sets(column: pa.Array, span: int) -> tuple[np.ndarray, np.ndarray]:
    """The members of all sets, rising within each, and the size of each: the popcount of a bitmap, half the bytes of a list."""
    data, at = _bytes_of(column)
    width = np.diff(at)
    dense = width == span // 8
    sizes = width // 2
    if dense.any():
        bits = np.unpackbits(data[ranges(at[:-1][dense], width[dense])], bitorder="little").reshape(-1, span)
        sizes[dense] = bits.sum(axis=1, dtype=np.int64)
    out = np.empty(int(sizes.sum()), dtype=np.int64)
    begin = np.cumsum(sizes) - sizes
    out[ranges(begin[~dense], sizes[~dense])] = np.ascontiguousarray(data[ranges(at[:-1][~dense], width[~dense])]).view("<u2")
    if dense.any():
        out[ranges(begin[dense], sizes[dense])] = np.nonzero(bits)[1]
    return out, sizes


def pack_planes(values: np.ndarray, sizes: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """For the values of each set (at least 0, one for each member) the bit planes of these, lowest first, and the number of planes of each set."""
    most = np.maximum.reduceat(values, np.cumsum(sizes) - sizes) if len(sizes) else np.zeros(0, dtype=np.int64)
    planes = np.zeros(len(sizes), dtype=np.int64)
    while (more := most >> planes > 0).any():
        planes[more] += 1
    width = -(-sizes // 8)
    ends = np.cumsum(width * planes)
    begin = ends - width * planes
    out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    for p in range(int(planes.max(initial=0))):
        here = planes > p
        own = values[np.repeat(here, sizes)]
        bits = np.zeros(int(width[here].sum()) * 8, dtype=np.uint8)
        bits[ranges((np.cumsum(width[here]) - width[here]) * 8, sizes[here])] = (own >> p) & 1
        out[ranges((begin + p * width)[here], width[here])] = np.packbits(bits, bitorder="little")
    return _binary(out, ends), planes


def unpack_planes(column: pa.Array, sizes: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """The values that pack_planes was given."""
    data, at = _bytes_of(column)
    width = -(-sizes // 8)
    out = np.zeros(int(sizes.sum()), dtype=np.int64)
    begin = np.cumsum(sizes) - sizes
    for p in range(int(planes.max(initial=0))):
        here = planes > p
        bits = np.unpackbits(data[ranges((at[:-1] + p * width)[here], width[here])], bitorder="little")
        out[ranges(begin[here], sizes[here])] |= bits[ranges((np.cumsum(width[here]) - width[here]) * 8, sizes[here])].astype(np.int64) << p
    return out
