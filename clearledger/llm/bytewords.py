"""Vectorised words and hashes over the UTF-8 bytes of Arrow text columns.

A word is a maximal run of bytes other than space and \\x09-\\x0D. All of these are ASCII, so
words of bytes are words of characters. Hashes are sums of byte values times powers of a base,
modulo the prime 2**61 - 1; a prefix sum gives the hash of any stretch at once. Values and base are
drawn from a seed. Two unlike stretches of n bytes have equal hashes for at most n of the 2**61
bases, so with a seed that no text was written for (``fresh_seed``) equal hashes mean equal bytes but
for some n in 2**61 pairs. The fixed ``SEED`` serves where hashes only name features.
"""

from __future__ import annotations

import secrets
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19
U64 = np.uint64
SEED = 20240607
PRIME = (1 << 61) - 1
#: Units that one prefix sum covers at most, but for a single longer stretch.
SPAN = 1 << 18
_P, _LOW31, _LOW30 = U64(PRIME), U64((1 << 31) - 1), U64((1 << 30) - 1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: Bytes outside words of letters and digits; all bytes of other alphabets' characters are inside.
SIGNS = np.ones(256, bool)
SIGNS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (the finaliser of splitmix64)."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


def fresh_seed() -> int:
    """A seed of the job, drawn on the driver and passed to its tasks."""
    return secrets.randbits(62)


def reduced(x: np.ndarray) -> np.ndarray:
    """Numbers below 2**64 modulo the prime."""
    x = (x & _P) + (x >> U64(61))
    return np.where(x >= _P, x - _P, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime of numbers below it, by halves of 31 bits."""
    a1, a0, b1, b0 = a >> U64(31), a & _LOW31, b >> U64(31), b & _LOW31
    middle = a1 * b0 + a0 * b1  # below 2**62
    return reduced((a1 * b1 << U64(1)) + (middle >> U64(30)) + ((middle & _LOW30) << U64(31)) + a0 * b0)


class Hashing:
    """Byte values, base and powers of one seed."""

    def __init__(self, seed: int):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.values = rng.integers(1, PRIME, 256, np.uint64)
        self.base = int(rng.integers(1 << 32, PRIME, dtype=np.uint64))
        self.inverse = pow(self.base, -1, PRIME)
        self.up = self.down = np.ones(1, U64)

    def powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The first n powers of the base and of its inverse; those of a span are kept."""
        up, down = self.up, self.down
        while len(up) < n:
            k = len(up)
            up = np.append(up, times(up, U64(pow(self.base, k, PRIME))))
            down = np.append(down, times(down, U64(pow(self.inverse, k, PRIME))))
        if len(up) <= 2 * SPAN:
            self.up, self.down = up, down
        return up[:n], down[:n]

    def prefixes(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums whose differences, times an inverse power, are hashes of stretches of
        values below the prime."""
        out = np.zeros(len(values) + 1, U64)
        scaled = times(values, self.powers(len(values))[0])
        high, low = np.cumsum(scaled >> U64(31), dtype=U64), np.cumsum(scaled & _LOW31, dtype=U64)
        high = reduced(high)
        out[1:] = reduced(((high << U64(31)) & _P) + (high >> U64(30)) + reduced(low))
        return out

    def stretches(self, prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of values[start:end] from their prefix sums."""
        apart = reduced(prefix[end] + (_P - prefix[start]))
        return mix(times(apart, self.powers(len(prefix))[1][start]))


@lru_cache(4)
def hashing(seed: int) -> Hashing:
    return Hashing(seed)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and where each row begins (n + 1 offsets); null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    if not len(column):
        return data[:0], np.zeros(1, np.int64)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batch: pa.RecordBatch, column: int, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about limit bytes of text, so that arrays per byte stay small."""
    _, offsets = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z as a-z."""
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each word, and the number of the first word of each row (n + 1).

    ``between`` says which bytes are not in words."""
    inside = ~between[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def _long_hash(h: Hashing, word: np.ndarray) -> int:
    """The hash of one stretch of any length, a span at a time."""
    total = 0
    for at in range(0, len(word), SPAN):
        part = int(h.prefixes(h.values[word[at : at + SPAN]])[-1])
        total = (total + part * pow(h.base, at, PRIME)) % PRIME
    return int(mix(np.array([total], U64))[0])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = SEED) -> np.ndarray:
    """A 64-bit hash of each word's bytes, worked out for a span of bytes at once."""
    out, h, at = np.zeros(len(starts), U64), hashing(seed), 0
    while at < len(starts):
        to = int(np.searchsorted(ends, starts[at] + SPAN, "right"))
        if to <= at:
            out[at] = _long_hash(h, data[starts[at] : ends[at]])
            at += 1
            continue
        s, e = starts[at:to], ends[at:to]
        out[at:to] = h.stretches(h.prefixes(h.values[data[s[0] : e[-1]]]), s - s[0], e - s[0])
        at = to
    return out
