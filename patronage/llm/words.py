"""Words and word hashes of whole Arrow columns of text, without a Python loop over words.

A word is a run of bytes other than blank, tab, line feed, vertical tab, form feed and
carriage return. Hashes have 64 bits: a sum of random values of the bytes, each times an odd
constant to the power of its place in the word, then mixed. They depend on the bytes alone,
so they agree between tasks, machines and runs.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# The helpers run in Python workers and travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK_BYTES = 1 << 19  # text handled at once; a longer text is a chunk of its own
BASE = 0x9E3779B97F4A7C15
SPACE = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_values(lower: bool) -> np.ndarray:
    """A random 64-bit value for each byte; with lower, A-Z have those of a-z."""
    v = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
    if lower:
        v[65:91] = v[97:123]
    return v


@dataclass
class Words:
    """Words of consecutive texts: byte range and hash of each word, and the number of the
    first word of each text (with one more entry for the end)."""

    data: np.ndarray
    text_from: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1

    def of(self, i: int) -> np.ndarray:
        return self.hashes[self.first[i]:self.first[i + 1]]

    def normal(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words of the chunk joined by single blanks, with the place of each word in it."""
        lengths = self.ends - self.starts
        after = np.cumsum(lengths + 1)
        at = after - lengths - 1
        out = np.full(int(after[-1]) if len(after) else 0, 32, np.uint8)
        shift = np.repeat(at - self.starts, lengths)
        inside = np.arange(len(shift)) - np.repeat(np.cumsum(lengths) - lengths, lengths) + np.repeat(self.starts, lengths)
        out[inside + shift] = self.data[inside]
        return out.tobytes(), at, at + lengths

    def joined(self, a: int, b: int) -> bytes:
        """Words number a to b (not included) of the chunk, joined by single blanks."""
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.starts[a:b], self.ends[a:b]))


def chunks(texts: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, pa.Array]]:
    """(from, to, texts) in pieces of about `limit` bytes; nulls become empty texts. Only the
    piece is copied, never the whole column."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    n, at = len(texts), np.concatenate([[0], np.cumsum(size)])
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + limit, side="right")) - 1)
        yield i, j, pc.fill_null(texts.slice(i, j - i).cast(pa.large_string()), "")
        i = j


def words(texts: pa.Array, lower: bool = False) -> Words:
    """Words of one piece from `chunks`."""
    kinds = np.ones(256, np.uint8)
    kinds[SPACE] = 0
    return tokens(texts, kinds, lower)


def tokens(texts: pa.Array, kinds: np.ndarray, lower: bool = False) -> Words:
    """Runs of bytes of one kind in one piece from `chunks`; kind 0 separates."""
    n = len(texts)
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[at[0]:at[-1]] if raw is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    at = at - at[0]
    size = len(data)
    kind = kinds[data]
    inside = kind > 0
    begins = np.zeros(size + 1, bool)
    begins[at] = True
    start, end = inside.copy(), inside.copy()
    changes = kind[1:] != kind[:-1]
    start[1:] &= changes | begins[1:size]
    end[:-1] &= changes | begins[1:size]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    if len(starts):
        lengths = ends - starts
        since = np.repeat(starts, np.diff(np.append(starts, size)))
        place = np.zeros(size, np.int64)
        place[starts[0]:] = np.arange(starts[0], size) - since
        powers = np.full(int(lengths.max()) + 1, BASE, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers)
        value = byte_values(lower)[data]
        value *= powers[np.minimum(place, len(powers) - 1)]
        value[~inside] = 0
        hashes = mix(np.add.reduceat(value, starts) + lengths.astype(np.uint64))
    else:
        hashes = np.zeros(0, np.uint64)
    return Words(data, at, starts, ends, hashes, np.searchsorted(starts, at))


def runs(hashes: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """Hash of each run of n consecutive words."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    m = len(hashes) - n + 1
    out = np.full(m, (salt * 2 + n) * 0xD6E8FEB86659FD93 & (2 ** 64 - 1), np.uint64)
    factor = 1
    for k in range(n):
        factor = factor * BASE % 2 ** 64
        out += hashes[k:k + m] * np.uint64(factor)
    return mix(out)
