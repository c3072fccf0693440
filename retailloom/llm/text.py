"""Vectorised words, shingles and hashes over Arrow text columns, for use inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_ODD = U64(0x9E3779B97F4A7C15)
_SLICE_BYTES = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    x *= U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(32)
    return x


def salt(number: int) -> np.uint64:
    """A constant for one use of ``mix``."""
    return mix(np.array([(number + 1) * 0x9E3779B97F4A7C15 % 2**64], U64))[0]


_BYTE_VALUE = mix(np.arange(1, 257, dtype=U64))


def _inverse(odd: int) -> int:
    return pow(odd, -1, 2**64)


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as the longest slice has needed."""

    up = down = np.ones(1, U64)

    @classmethod
    def first(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 2 * _SLICE_BYTES)
            with np.errstate(over="ignore"):
                steps = np.full(size, _ODD, U64)
                steps[0] = 1
                back = np.full(size, U64(_inverse(int(_ODD))), U64)
                back[0] = 1
                cls.up, cls.down = np.cumprod(steps), np.cumprod(back)
        return cls.up[:n], cls.down[:n]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and where each row begins and ends in them; NULL is empty."""
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(column: pa.Array, limit: int = _SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole rows of about ``limit`` bytes, so that temporary arrays stay small: (first row, end row, bytes, offsets)."""
    data, at = buffers(column)
    first = 0
    while first < len(column):
        end = max(first + 1, int(np.searchsorted(at, at[first] + limit, "right")) - 1)
        end = min(end, len(column), first + 60_000)
        yield first, end, data[at[first] : at[end]], at[first : end + 1] - at[first]
        first = end


def byte_classes(kept: str, lower: bool) -> np.ndarray:
    """What each byte counts as: 0 for a separator, else the byte, ASCII letters lowered if asked."""
    table = np.zeros(256, np.uint8)
    for b in range(256):
        if kept == "alphanumeric":
            keep = 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80
        else:
            keep = b != 0x20 and not 0x09 <= b <= 0x0D
        table[b] = (b | 0x20 if lower and 0x41 <= b <= 0x5A else b) if keep else 0
    return table


#: The words of the benchmark and similarity contracts: after lower-casing A-Z, all but ASCII punctuation, controls and blanks.
PLAIN_WORDS = byte_classes("alphanumeric", lower=True)
#: Words between ASCII white space, as written.
SPACED_WORDS = byte_classes("spaced", lower=False)


class Words:
    """Words of consecutive rows: where each begins and ends, its row, and a 64-bit hash of its bytes."""

    def __init__(self, data: np.ndarray, at: np.ndarray, classes: np.ndarray):
        rows = len(at) - 1
        folded = classes[data]
        inside = folded != 0
        opens, closes = inside.copy(), inside.copy()
        if len(data):
            edges = at[:-1][at[:-1] < len(data)]
            before = np.zeros(len(data), bool)
            before[1:] = inside[:-1]
            before[edges] = False
            after = np.zeros(len(data), bool)
            after[:-1] = inside[1:]
            after[edges[edges > 0] - 1] = False
            opens &= ~before
            closes &= ~after
        self.begin = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        bounds = np.searchsorted(self.begin, at)
        self.first, self.count = bounds[:-1], np.diff(bounds)
        self.row = np.repeat(np.arange(rows), self.count)
        self.folded = folded
        with np.errstate(over="ignore"):
            up, down = _Powers.first(len(data) + 1)
            sums = np.zeros(len(data) + 1, U64)
            np.cumsum(_BYTE_VALUE[folded] * up[:-1], out=sums[1:])
            self.hash = mix((sums[self.end] - sums[self.begin]) * down[self.begin])


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every run of ``size`` words; a row of fewer words, but not none, has one run of them all."""
    with np.errstate(over="ignore"):
        weights = [mix(np.array([j + 1], U64))[0] | U64(1) for j in range(size)]
        full = max(0, len(words.hash) - size + 1)
        total = np.zeros(full, U64)
        for j, weight in enumerate(weights):
            total += words.hash[j : j + full] * weight
        whole = words.row[:full] == words.row[size - 1 :] if full else np.zeros(0, bool)
        row, value = words.row[:full][whole], total[whole]
        short = np.flatnonzero((words.count > 0) & (words.count < size))
        if len(short):
            part = np.zeros(len(short), U64)
            for j, weight in enumerate(weights):
                has = words.count[short] > j
                part[has] += words.hash[words.first[short][has] + j] * weight
            row, value = np.concatenate([row, short]), np.concatenate([value, part])
        return row, mix(value)


def ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All indices of many half-open ranges: (which range, index)."""
    sizes = np.maximum(high - low, 0)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.cumsum(sizes) - sizes
    return owner, np.arange(len(owner)) - starts[owner] + low[owner]


def list_column(values: np.ndarray, sizes: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column from flat values and the length of each row's list."""
    ends = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def binary_column(block: np.ndarray) -> pa.BinaryArray:
    """A binary column from the rows of a two-dimensional byte array."""
    rows, width = block.shape
    ends = pa.py_buffer(np.arange(rows + 1, dtype=np.int32) * np.int32(width))
    return pa.BinaryArray.from_buffers(pa.binary(), rows, [None, ends, pa.py_buffer(np.ascontiguousarray(block))])
