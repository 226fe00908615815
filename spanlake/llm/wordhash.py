"""Words of Arrow string batches as 64-bit hashes, computed with vector operations.

A word is a run of the characters `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` after
lower-casing A-Z: digits, ASCII letters and everything beyond ASCII. In UTF-8
that is a property of single bytes, so words are found on the batch's byte
buffer. The hash of a word of up to LONG bytes is a polynomial in an odd base
over random byte values, modulo 2^64, read from prefix sums, then mixed. Such
polynomials collide on certain long words, so longer ones get a seeded xxHash
of their bytes.
"""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa
import xxhash

SEED = 20240607
LONG = 32
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _tables(n: int):
    """(byte map, byte values, powers of the base, inverse powers) for n bytes.
    A worker keeps one copy for all its tasks."""
    state = sys.modules.setdefault("_spanlake_wordhash", types.ModuleType("_spanlake_wordhash")).__dict__
    if "map" not in state:
        low = np.zeros(256, np.uint8)
        for c in [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]:
            low[c] = c
        low[0x41:0x5B] = np.arange(0x61, 0x7B)
        state["map"] = low
        state["values"] = np.random.default_rng(SEED).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        state["inverse"] = np.uint64(pow(int(_BASE), -1, 1 << 64))
        state["n"] = 0
    if state["n"] < n:
        size = max(n, 1 << 20)
        with np.errstate(over="ignore"):
            ones = np.full(size, _BASE)
            ones[0] = 1
            state["powers"] = np.multiply.accumulate(ones)
            ones = np.full(size, state["inverse"])
            ones[0] = 1
            state["inverses"] = np.multiply.accumulate(ones)
        state["n"] = size
    return state["map"], state["values"], state["powers"], state["inverses"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def string_bytes(texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """(the bytes of all texts, offsets of each text in them)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_string(texts.type)
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    if n == 0 or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


class Words:
    """The words of a batch: `hash` per word, `first[i]:first[i+1]` the words
    of text i; `prefix(k)` hashes the first k bytes of each word."""

    def __init__(self, texts: pa.StringArray):
        data, offsets = string_bytes(texts)
        n = len(data)
        low, values, powers, self._inverses = _tables(n + 1)
        data = low[data]
        inside = data != 0
        fresh = np.zeros(n + 1, bool)
        fresh[offsets] = True
        begins, closes = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | fresh[1:n]
        closes[:-1] &= ~inside[1:] | fresh[1:n]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(closes) + 1
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[data] * powers[:n], out=self._sums[1:])
        self.first = np.searchsorted(self.start, offsets)
        self.hash = self._of(self.start, self.end)
        long = np.flatnonzero(self.end - self.start > LONG)
        if len(long):
            raw = memoryview(data)
            self.hash[long] = [xxhash.xxh3_64_intdigest(raw[a:b], SEED) for a, b in zip(self.start[long].tolist(), self.end[long].tolist())]

    def _of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._inverses[start] + (end - start).astype(np.uint64))

    def prefix(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers with more than k bytes, hashes of their first k)."""
        long = np.flatnonzero(self.end - self.start > k)
        return long, self._of(self.start[long], self.start[long] + k)
