"""Texts of an Arrow column as flat numpy arrays: bytes, words, 64-bit hashes, hash tables, ragged gathers.

A null text counts as an empty one. Texts are taken in slices of about `SLICE` bytes (one longer text makes
a slice of its own), so the working memory of a task follows the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 1 << 20
U64 = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_HASH = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
LOWER_HASH = BYTE_HASH.copy()
LOWER_HASH[65:91] = BYTE_HASH[97:123]
STEP = 0x9E3779B97F4A7C15 | 5
IS_WORD = np.ones(256, dtype=bool)
IS_WORD[[0x20, *range(0x09, 0x0E)]] = False


def slices(column: pa.Array, most: int = SLICE, rows: int = 1 << 30) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of the rows within them) for runs of up to `rows` rows, of about `most` bytes."""
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return
    at = np.frombuffer(offsets, wide)[column.offset:column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = int(np.searchsorted(at, at[row] + most, side="right")) - 1
        end = min(n, max(end, row + 1), row + rows)
        yield row, raw[at[row]:at[end]], at[row:end + 1] - at[row]
        row = end


class _Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as far as they were needed so far."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up, self.down = np.ones(1, U64), np.ones(1, U64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = _powers(self.base, size), _powers(self.inverse, size)
        return self.up[:n], self.down[:n]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U64(base & (1 << 64) - 1))
    out[0] = 1
    return np.cumprod(out, dtype=U64)


_byte_powers, _word_powers = _Powers(STEP), _Powers(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection)."""
    h = h ^ (h >> U64(30))
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = BYTE_HASH) -> np.ndarray:
    """64-bit hash of each byte span [start, end), which must not be empty."""
    if not len(starts):
        return np.zeros(0, U64)
    up, down = _byte_powers.to(len(buf))
    value = table[buf]
    value *= up
    total = np.cumsum(value, dtype=U64)
    h = total[ends - 1] - total[starts] + value[starts]
    h *= down[starts]
    h += (ends - starts).astype(U64) * U64(0x2545F4914F6CDD1D)
    return mix(h)


class Words:
    """Words of a slice: byte spans, and for each text the range of its words.

    A word is a run of bytes that `table` marks, by default `[^\\x20\\x09-\\x0D]+`.
    """

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, table: np.ndarray = IS_WORD):
        self.buf, self.offsets = buf, offsets
        word = table[buf]
        before = np.empty_like(word)
        before[:1], before[1:] = False, word[:-1]
        firsts = offsets[:-1]
        before[firsts[firsts < len(buf)]] = False
        after = np.empty_like(word)
        after[-1:], after[:-1] = False, word[1:]
        lasts = offsets[1:] - 1
        after[lasts[lasts >= 0]] = False
        self.starts = np.flatnonzero(word & ~before)
        self.ends = np.flatnonzero(word & ~after) + 1
        self.bounds = np.searchsorted(self.starts, offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        return span_hashes(self.buf, self.starts, self.ends, LOWER_HASH if lower else BYTE_HASH)


def windows(h: np.ndarray, owners: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first word, hash) of every run of k words that lies within one text."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    up, down = _word_powers.to(len(h))
    total = np.zeros(len(h) + 1, U64)
    np.cumsum(h * up, dtype=U64, out=total[1:])
    w = (total[k:] - total[:-k]) * down[:n]
    at = np.flatnonzero(owners[:n] == owners[k - 1:])
    return at, mix(w[at] + U64(k))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of each span, one span after the other."""
    total = int(lengths.sum())
    out = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    out += np.arange(total)
    return out


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of values[bounds[i]:bounds[i+1]] for each i."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


class KeyTable:
    """Map from 64-bit keys to numbers from 0, looked up and filled by whole arrays (open addressing)."""

    def __init__(self, bits: int):
        self.bits = bits
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << self.bits, U64)
        self.values = np.full(1 << self.bits, -1, np.int32)
        self.size = 0

    @property
    def room(self) -> int:
        return (1 << self.bits) // 2 - self.size

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * U64(0x9E3779B97F4A7C15)) >> U64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each key, -1 for one that is absent."""
        slot = self._slots(keys)
        value = self.values[slot]
        wrong = np.flatnonzero((value >= 0) & (self.keys[slot] != keys))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & ((1 << self.bits) - 1)
            value[wrong] = self.values[slot[wrong]]
            wrong = wrong[(value[wrong] >= 0) & (self.keys[slot[wrong]] != keys[wrong])]
        return value

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add distinct absent keys; the table must stay at most half full."""
        if len(keys) > self.room:
            raise ValueError("key table is full")
        values = values.astype(np.int32)
        slot, left = self._slots(keys), np.arange(len(keys))
        while len(left):
            free = left[self.values[slot[left]] < 0]
            self.values[slot[free]] = values[free]
            won = free[self.values[slot[free]] == values[free]]
            self.keys[slot[won]] = keys[won]
            left = left[self.values[slot[left]] != values[left]]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
        self.size += len(keys)
