"""SuperMinHash signatures of word-shingle sets, for whole Arrow batches at a time.

Each element of a set draws, from its hash, a random permutation of the ``m`` slots and random fractions; at
level j it offers ``j + fraction`` to the j-th slot of its permutation, and a slot keeps its least offer. A
set's levels end as soon as all its slots hold offers of earlier levels, so a set of n elements costs about
max(n, m log m) steps. Slots of two sets agree with the probability of their Jaccard similarity, with lower
variance than independent permutations give.
"""

from __future__ import annotations

import numpy as np

from tidemark.llm.wordscan import U64, Words, mix, windows

SLOTS = 128
_GOLDEN = 0x9E3779B97F4A7C15
_WRAP = (1 << 64) - 1
_FRACTION = U64((1 << 48) - 1)


def shingles(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document, sorted within it, and the bounds of the documents.

    A document of fewer than ``width`` words has its whole sequence as its one shingle; one without words none.
    """
    hashes, count = words.hashes(lower=True), words.count
    first, n = words.first[:-1], np.where(count >= width, count - width + 1, np.minimum(count, 1))
    bound = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(bound[-1], U64)
    full = windows(hashes, width, width)
    long_ = count >= width
    if long_.any():
        lengths = n[long_]
        at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[np.repeat(bound[:-1][long_], lengths) + at] = full[np.repeat(first[long_], lengths) + at]
    for k in range(1, width):
        short = np.flatnonzero(count == k)
        if len(short):
            out[bound[:-1][short]] = windows(hashes, k, k)[first[short]]
    for a, b in zip(bound[:-1].tolist(), bound[1:].tolist()):
        out[a:b].sort()
    keep = np.ones(len(out), bool)
    keep[1:] = out[1:] != out[:-1]
    keep[bound[:-1][n > 0]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])[bound]
    return out[keep], kept


def signatures(elements: np.ndarray, bound: np.ndarray, m: int = SLOTS) -> np.ndarray:
    """The (documents x m) SuperMinHash signatures of sets ``elements[bound[d]:bound[d + 1]]``."""
    docs = len(bound) - 1
    out = np.full(docs * m, np.iinfo(np.uint64).max, U64)
    owner = np.repeat(np.arange(docs), np.diff(bound))
    swaps: list[np.ndarray] = []
    for level in range(m):
        if not len(owner):
            break
        u = mix(elements + U64((level + 1) * _GOLDEN & _WRAP))
        slot = ((u >> U64(48)) * U64(m - level) >> U64(16)).astype(np.int16) + np.int16(level)
        at = slot.copy()
        for i in range(level - 1, -1, -1):  # what the earlier swaps of the permutation have left there
            here = swaps[i]
            back = at == here
            forth = at == i
            at[forth] = here[forth]
            at[back] = i
        np.minimum.at(out, owner * m + at, U64(level) << U64(48) | (u & _FRACTION))
        swaps.append(slot)
        worst = out.reshape(docs, m).max(axis=1)
        open_ = worst[owner] >= U64(level + 1) << U64(48)
        if not open_.all():
            elements, owner, swaps = elements[open_], owner[open_], [x[open_] for x in swaps]
    return out.reshape(docs, m)


def bands(signature: np.ndarray, rows: int = 4) -> np.ndarray:
    """One 64-bit hash for each band of ``rows`` slots, different bands hashing apart."""
    docs, m = signature.shape
    parts = signature.reshape(docs, m // rows, rows)
    out = np.broadcast_to(np.arange(m // rows, dtype=U64) * U64(_GOLDEN), (docs, m // rows)).copy()
    for i in range(rows):
        out *= U64(0xC2B2AE3D27D4EB4F)
        out += parts[:, :, i]
    return mix(out)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    return len(np.intersect1d(a, b, assume_unique=True))
