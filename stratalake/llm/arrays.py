"""Text as numpy arrays inside Spark tasks: words, rolling hashes, window minima.

Every function takes a batch of documents as one byte buffer with offsets, so
that the work per document is a share of a few array operations.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
# Random codes of the 256 bytes and two odd multipliers, the same in every process.
BYTE_CODES = _rng.integers(0, 2**64, 256, dtype=U64)
BASE_A, BASE_B = (int(x) | 5 for x in _rng.integers(2**60, 2**63, 2, dtype=U64))
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
# Positions of a window minimum are kept in the low bits of the compared keys.
_POSITION_BITS = 24


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null reads as empty."""
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``limit`` bytes together, or one longer document."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads each 64-bit value over all bits."""
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def _power_table(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    if base not in _powers or len(_powers[base][0]) < n:
        size = 1 << max(18, (n - 1).bit_length())
        tables = []
        for factor in (base, pow(base, -1, 2**64)):
            steps = np.full(size, factor, U64)
            steps[0] = 1
            tables.append(np.cumprod(steps, dtype=U64))
        _powers[base] = tuple(tables)
    return _powers[base]


class Rolling:
    """Hashes of any ranges of a sequence of 64-bit codes, from prefix sums modulo 2**64."""

    def __init__(self, codes: np.ndarray, base: int = BASE_A):
        power, self._inverse = _power_table(base, len(codes) + 1)
        self._sums = np.zeros(len(codes) + 1, U64)
        np.cumsum(codes * power[: len(codes)], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        span = (self._sums[end] - self._sums[start]) * self._inverse[start]
        return mix(span + (end - start).astype(U64) * U64(0x9E3779B97F4A7C15))

    def grams(self, k: int) -> np.ndarray:
        """The hash of each run of k codes, also those that cross documents."""
        n = len(self._sums) - 1
        if n < k:
            return np.zeros(0, U64)
        span = (self._sums[k:] - self._sums[:-k]) * self._inverse[: n - k + 1]
        return mix(span + U64(k * 0x9E3779B97F4A7C15 % 2**64))


class Words:
    """Runs of bytes other than blanks (space, 9 to 13), which never cross documents."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        blank = _BLANK[raw]
        head = np.zeros(len(raw) + 1, bool)
        head[offsets] = True
        left = head[:-1].copy()
        left[1:] |= blank[:-1]
        right = head[1:].copy()
        right[:-1] |= blank[1:]
        if len(raw):
            right[-1] = True
        self.raw = raw
        self.start = np.flatnonzero(~blank & left)
        self.end = np.flatnonzero(~blank & right) + 1
        self.doc = np.searchsorted(offsets[1:], self.start, side="right")
        self.counts = np.bincount(self.doc, minlength=len(offsets) - 1).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.counts)])

    def codes(self) -> np.ndarray:
        """A 64-bit code of each word."""
        return Rolling(BYTE_CODES[self.raw]).of(self.start, self.end)


def window_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values, the position of the least one, the leftmost on ties.

    Values compare by their upper 40 bits.
    """
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    step = (1 << _POSITION_BITS) - width
    if n > 1 << _POSITION_BITS:
        parts = range(0, n - width + 1, step)
        return np.concatenate([window_argmin(values[lo : lo + step + width - 1], width) + lo for lo in parts])
    key = (values >> U64(_POSITION_BITS) << U64(_POSITION_BITS)) | np.arange(n, dtype=U64)
    size = 1
    while 2 * size <= width:
        key = np.minimum(key[:-size], key[size:])
        size *= 2
    if size < width:
        key = np.minimum(key[: size - width], key[width - size :])
    return (key & U64((1 << _POSITION_BITS) - 1)).astype(np.int64)


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return x.astype(U64, copy=False).view(np.int64)


def cut_out(raw: bytes, starts: np.ndarray, lengths: np.ndarray) -> tuple[bytes, int, int]:
    """The bytes outside the given spans, how many were inside, and in how many runs."""
    change = np.zeros(len(raw) + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + lengths, -1)
    gone = np.cumsum(change[:-1]) > 0
    runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(raw, np.uint8)[~gone].tobytes(), int(gone.sum()), runs
