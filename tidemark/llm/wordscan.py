"""Vectorised word scanning over Arrow string batches.

Every operator that walks words (substring and near dedup, quality rules, toxicity, decontamination)
shares this scanner. It works on the UTF-8 buffer of a whole Arrow column at once: a word is a maximal run
of bytes outside 0x20 and 0x09-0x0D, which is exact on UTF-8 because those separators are ASCII. Null texts
count as empty. Memory is a small multiple of the batch's bytes, and batches are cut by ``slices``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_MULTIPLIER = U64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection of 64-bit values with good avalanche."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


#: A random 64-bit value for every byte, and powers of an odd multiplier, for the polynomial word hash.
_BYTE = mix(np.arange(1, 257, dtype=U64) * _MULTIPLIER)
_POWER = np.ones(1, U64)


def powers(n: int) -> np.ndarray:
    """The first n powers of the word hash's multiplier."""
    global _POWER
    while len(_POWER) < n:
        step = _POWER[-1:] * U64(0xD6E8FEB86659FD93)
        _POWER = np.concatenate([_POWER, _POWER * step])
    return _POWER[:n]


@dataclass
class Words:
    """Words of one batch: byte ``start``/``end`` in ``data``, and for document d its words
    ``first[d]:first[d + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    text_start: np.ndarray
    text_end: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """Document index of every word."""
        return np.repeat(np.arange(len(self.first) - 1), self.count)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of every word's bytes (A-Z lower-cased on request)."""
        if not len(self.start):
            return np.zeros(0, U64)
        table = _BYTE[_LOWER] if lower else _BYTE
        length = self.end - self.start
        out = np.empty(len(length), U64)
        # By blocks of about a million bytes: temporaries stay in cache and memory stays bounded.
        edge = np.concatenate([[0], np.cumsum(length)])
        cuts = np.searchsorted(edge, np.arange(0, edge[-1], 1 << 18), side="left")
        cuts = np.unique(np.concatenate([[0], cuts, [len(length)]]))
        power = powers(int(length.max()) + 1)
        for a, b in zip(cuts[:-1], cuts[1:]):
            n = length[a:b]
            at = edge[a:b] - edge[a]
            within = np.arange(edge[b] - edge[a]) - np.repeat(at, n)
            value = table[self.data[within + np.repeat(self.start[a:b], n)]]
            value *= power[within]
            out[a:b] = np.add.reduceat(value, at)
        out += length.astype(U64) * _MULTIPLIER
        return mix(out)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def scan(text: pa.Array | pa.ChunkedArray) -> Words:
    """Find the words of a string column."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks() if text.num_chunks != 1 else text.chunk(0)
    if isinstance(text, pa.ChunkedArray):
        text = pa.concat_arrays(text.chunks)
    if text.null_count:
        text = text.fill_null("")
    wide = text.type in (pa.large_string(), pa.large_binary())
    offsets = np.frombuffer(text.buffers()[1], np.int64 if wide else np.int32)[text.offset : text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int32)
    offsets = offsets.astype(np.int64)
    buffer = text.buffers()[2] if len(text) else None
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    lo, hi = (int(offsets[0]), int(offsets[-1])) if len(text) else (0, 0)
    data, offsets = data[lo:hi], offsets - lo
    inside = ~_SEPARATOR[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    begins[edge] |= inside[edge]  # a word never runs on into the next document
    ends[edge - 1] |= inside[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    return Words(data, start, end, first, offsets[:-1], offsets[1:])


def windows(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``width`` word hashes (the last width - 1 positions are left out)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.full(n, U64(seed), U64)
    odd = U64(0xC2B2AE3D27D4EB4F)
    for i in range(width):
        out *= odd
        out += hashes[i : i + n]
    return mix(out)


def slices(batch: pa.RecordBatch, column: str = "text", most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``most`` bytes of text; a longer single row stays whole."""
    if not batch.num_rows:
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
    total = np.cumsum(sizes)
    a = 0
    while a < batch.num_rows:
        b = int(np.searchsorted(total, (total[a - 1] if a else 0) + most, side="right"))
        b = max(b, a + 1)
        yield batch.slice(a, b - a)
        a = b
