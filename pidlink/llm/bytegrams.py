"""Words and hashed n-grams of many texts at once, as numpy operations on one byte buffer."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Odd multipliers of the polynomial and of the final mixing (any odd 64-bit numbers do).
BASES = (U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F))
MIX = U64(0xD6E8FEB86659FD93)
#: Bytes whose running sums are held at once (a longer word is a block of its own).
BLOCK = 1 << 19
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U64(base), dtype=U64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    return _powers(int(base), 1 << max(n - 1, 1).bit_length())[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U64(32))) * MIX
    return (h ^ (h >> U64(29))) * MIX


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of an Arrow string array, and where each text begins and the last one ends.
    Nulls are empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1]
    at = at.astype(np.int64)
    if data is None or not len(at):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0]:at[-1]], at - at[0]


def words_of(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word of the texts, in order."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~_SPACE[data]
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[at[:-1][at[:-1] < len(data)]] = False  # a text begins: no word crosses it
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    last = at[1:] - 1
    after[last[last >= 0]] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(at, starts, side="right") - 1


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Rabin-Karp hash of each span of a sequence of numbers: the polynomial of its values
    modulo 2**64. All spans are taken from one running sum; a power of the base aligns each to
    the same place, so equal spans have equal hashes wherever they stand."""
    size = len(values)
    pw = powers(int(base), size + 1)
    total = np.concatenate([np.zeros(1, U64), np.cumsum(values.astype(U64) * pw[:size][::-1], dtype=U64)])
    inverse = powers(pow(int(base), -1, 1 << 64), size + 1)
    return (total[ends] - total[starts]) * inverse[size - ends]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A 64-bit hash of each word, block by block of the buffer."""
    out = np.empty(len(starts), U64)
    first = 0
    while first < len(starts):
        last = max(int(np.searchsorted(ends, starts[first] + BLOCK, side="right")), first + 1)
        a, b = starts[first], ends[last - 1]
        s, e = starts[first:last] - a, ends[first:last] - a
        out[first:last] = mixed(span_hashes(data[a:b].astype(U64) + U64(1), s, e, base) + (e - s).astype(U64))
        first = last
    return out
