"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of Arrow batches.

A word is a run of bytes that are no separators; separators are single ASCII bytes, so no character is cut. A word's
64-bit hash is a polynomial over random byte values, read from prefix sums; sequences of words are hashed the same way
from the word hashes. Work goes in blocks of half a megabyte that end between words, so memory follows the batch, not
the corpus.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19
SLICE = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
SPACES = bytes([0x20, *range(0x09, 0x0E)])
NOT_ALNUM = bytes(b for b in range(128) if not (48 <= b <= 57 or 97 <= b <= 122))

_values = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: np.uint64, n: int) -> np.ndarray:
    table = _powers.get(int(base))
    if table is None or len(table) < n:
        size = max(n, BLOCK + 1)
        table = np.full(size, base, np.uint64)
        table[0] = 1
        table = np.multiply.accumulate(table)
        _powers[int(base)] = table
    return table


def _inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 2**64))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Pattern:
    """Which bytes belong to words; ``lower`` treats A-Z like a-z."""

    def __init__(self, separators: bytes, lower: bool) -> None:
        self.fold = np.arange(256, dtype=np.uint8)
        if lower:
            self.fold[65:91] += 32
        self.inside = np.ones(256, bool)
        self.inside[list(separators)] = False
        self.inside = self.inside[self.fold]
        self.values = _values[self.fold]


PLAIN = Pattern(SPACES, lower=False)
LOWER = Pattern(SPACES, lower=True)
ALNUM = Pattern(NOT_ALNUM, lower=True)


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return (body[at[0] : at[-1]], at - at[0]) if len(at) else (body[:0], np.zeros(1, np.int64))


def slices(batches: Iterator[pa.RecordBatch], column: str, size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Batches of at most about ``size`` bytes of ``column``, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = raw(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(at, at[start] + size, "right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop
    release()


def release() -> None:
    """Give freed memory back at the end of a task: Python workers live on and share their executor's memory."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Words:
    """Words of a column: byte ``starts`` and ``ends``, ``hashes``, and per text its range ``first[i]:first[i + 1]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, pattern: Pattern, hashed: bool = True) -> None:
        self.data, self.offsets, self.pattern = data, offsets, pattern
        inside = pattern.inside[data]
        begin, finish = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        finish[:-1] &= ~inside[1:]
        filled = offsets[1:] > offsets[:-1]
        edges = offsets[:-1][filled]
        begin[edges] = inside[edges]
        edges = offsets[1:][filled] - 1
        finish[edges] = inside[edges]
        self.starts, self.ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.hashes = self._hash() if hashed else None

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        """Number of the text of every word."""
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts())

    def _hash(self) -> np.ndarray:
        return blocks_of_spans(self.pattern.values, self.data, self.starts, self.ends)

    def windows(self, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of ``size`` consecutive words of one text by their first word, and those first words."""
        starts = self.window_starts(size)
        return sequence_hashes(self.hashes, starts, size, seed), starts

    def window_starts(self, size: int) -> np.ndarray:
        last = self.first[1:] - size
        counts = np.maximum(last - self.first[:-1] + 1, 0)
        shift = self.first[:-1] - (np.cumsum(counts) - counts)
        return np.arange(counts.sum()) + np.repeat(shift, counts)


def spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64 = BASE) -> np.ndarray:
    """Polynomial hash of ``values[starts[i]:ends[i]]``."""
    n = len(values)
    power = _power_table(base, n + 1)
    back = _power_table(_inverse(base), n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values * power[:n], out=sums[1:])
    return (sums[ends] - sums[starts]) * back[starts]


def blocks_of_spans(values: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the bytes ``data[starts[i]:ends[i]]``, whose values are ``values``; spans are in order."""
    out = np.empty(len(starts), np.uint64)
    done = 0
    while done < len(starts):
        stop = max(done + 1, int(np.searchsorted(ends, starts[done] + BLOCK, "right")))
        low, high = int(starts[done]), int(ends[stop - 1])
        out[done:stop] = spans(values[data[low:high]], starts[done:stop] - low, ends[done:stop] - low)
        done = stop
    return mix(out ^ (ends - starts).astype(np.uint64))


def sequence_hashes(hashes: np.ndarray, starts: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of ``size`` word hashes from each start; ``seed`` gives independent hashes."""
    base = BASE + np.uint64(2 * (2 * seed + 1) * 0x51ED270B)
    out = np.zeros(len(starts), np.uint64)
    for j in range(size) if size <= 5 else ():
        out = out * base + hashes[starts + j]
    if size > 5:
        out = spans(hashes, starts, starts + size, base)
    return mix(out + np.uint64(seed * 7919 + size))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def binary_array(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary value per row: ``counts[i]`` consecutive items of ``values``."""
    at = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts * values.itemsize, out=at[1:])
    body = pa.py_buffer(np.ascontiguousarray(values))
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(at), body]).cast(pa.binary())
