"""Numpy views of Arrow text columns: words, lines and rolling hashes without Python strings.

Everything here works on the UTF-8 bytes of many rows at once. A hash of the bytes
``[s, e)`` is ``(P[e] - P[s]) * B**-s`` modulo 2**64, where ``P`` are prefix sums of
``value(byte) * B**position``: one pass gives the hash of any stretch in O(1).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
CHUNK_BYTES = 1 << 20


def text_column(col) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (n + 1) of a string or binary column; a null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null(b"" if pa.types.is_binary(col.type) else "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    if len(col) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer row stays whole in a range of its own."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(n, max(end, row + 1))
        yield row, end
        row = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x2545F4914F6CDD1D))


def powers(n: int, base: np.uint64) -> np.ndarray:
    out = np.ones(max(n, 1), np.uint64)
    out[1:] = base
    return np.multiply.accumulate(out)


class Roller:
    """Hashes of any stretch of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(n, BASE), out=self.prefix[1:])
        self.back = powers(n + 1, BASE_INVERSE)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.prefix[end] - self.prefix[start]) * self.back[start])


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(inside, start, end, row) of the words ``[^\\x20\\x09-\\x0D]+``; none crosses a row's end."""
    space = np.zeros(256, bool)
    space[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    inside = ~space[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edge = offsets[:-1][offsets[:-1] < offsets[1:]]
    before[edge] = False
    after[edge[1:] - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return inside, start, end, np.searchsorted(offsets, start, "right") - 1


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of set flags in each row."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def repeated(keys: np.ndarray) -> np.ndarray:
    """Flags of the keys that occur twice or more."""
    if len(keys) < 2:
        return np.zeros(len(keys), bool)
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys
