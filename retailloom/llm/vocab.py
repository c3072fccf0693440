"""Words of Arrow text columns as codes into the distinct words, exactly, by their bytes."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] |= 0x20


class Coded:
    """Words of consecutive rows: where each begins and ends, its row, and its code into ``values``."""

    def __init__(self, data: np.ndarray, at: np.ndarray, kept: np.ndarray, lower: bool = True, parted: np.ndarray | None = None):
        """``kept`` says of each of the 256 bytes whether it belongs to a word; a row's edge ends a word, and so does a place in ``parted``.

        A-Z are lowered if asked."""
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = kept[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[at] = True
        if parted is not None:
            edge[parted] = True
        self.begin = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
        self.end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
        self.row = np.searchsorted(at, self.begin, "right") - 1
        offsets = np.zeros(len(self.begin) + 1, np.int64)
        np.cumsum(self.end - self.begin, out=offsets[1:])
        raw = data[inside[1:-1]]
        raw = pa.py_buffer(LOWER[raw] if lower else raw)
        words = pa.LargeStringArray.from_buffers(len(self.begin), pa.py_buffer(offsets), raw)
        coded = words.dictionary_encode()
        self.codes = coded.indices.to_numpy()
        self.values: pa.Array = coded.dictionary


def unified(parts: Iterable[tuple[np.ndarray, pa.Array]]) -> tuple[list[np.ndarray], pa.Array]:
    """Codes into several word lists as codes into one."""
    parts = list(parts)
    joined = pa.concat_arrays([values for _, values in parts]) if parts else pa.array([], pa.large_string())
    one = joined.dictionary_encode()
    index, codes, begin = one.indices.to_numpy(), [], 0
    for own, values in parts:
        codes.append(index[begin : begin + len(values)][own] if len(values) else own)
        begin += len(values)
    return codes, one.dictionary


def bit(word: Column, bits: int) -> Column:
    """A word's place in a bitmap of 2^bits; tasks compute the same by crc32."""
    return F.crc32(word.cast("binary")) % (1 << bits)


def bitmap(words: DataFrame, column: str, bits: int = 24) -> np.ndarray:
    """One byte per eight places, at most 2^bits / 8 bytes however many words there are; gathered by tasks as 32-bit pieces."""
    place = words.select(bit(F.col(column), bits).alias("place"))
    pieces = place.groupBy(F.shiftright("place", 5).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 31 as int))")).alias("mask")).toArrow()
    out = np.zeros(1 << bits >> 5, np.uint32)
    out[pieces["at"].to_numpy()] = pieces["mask"].to_numpy().astype(np.uint32)
    return out
