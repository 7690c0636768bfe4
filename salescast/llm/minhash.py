"""Word-shingle sets and their MinHash signatures, by numpy."""

from __future__ import annotations

import numpy as np

from salescast.llm.text import SPACED, Words, mix

_ROLL = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
                 dtype=np.uint64)


def _multipliers(count: int) -> np.ndarray:
    return mix(np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x8CB92BA72F3D8DD7)) | np.uint64(1)


def shingle_sets(column, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row as sorted hashes, one row after the other, and where each row begins.

    A shingle is ``size`` words; a row with fewer words has them all as its only one, a row without words none.
    """
    words = Words(column, SPACED)
    hashes, n = words.hashes(), np.diff(words.first)
    count = np.maximum(n - size + 1, (n > 0).astype(n.dtype))
    begin = np.concatenate([[0], np.cumsum(count)])
    row = np.repeat(np.arange(len(n)), count)
    at = np.arange(begin[-1]) - begin[row] + words.first[row]
    out = np.zeros(len(at), np.uint64)
    last = words.first[row + 1]
    for k in range(size):
        inside = at + k < last
        out[inside] += mix((hashes[at[inside] + k] + np.uint64(k + 1)) * _ROLL[k % len(_ROLL)])
    mix(out)
    kept, sizes = [], np.zeros(len(n) + 1, np.int64)
    for i in range(len(n)):
        own = np.unique(out[begin[i]: begin[i + 1]])
        kept.append(own)
        sizes[i + 1] = len(own)
    return np.concatenate(kept) if kept else out, np.cumsum(sizes)


def signatures(sets: np.ndarray, begin: np.ndarray, count: int) -> np.ndarray:
    """``count`` MinHash values for each row, every coordinate in a value range of its own; empty sets have zeros."""
    full = np.flatnonzero(np.diff(begin))
    out = np.zeros((len(begin) - 1, count), np.uint64)
    if len(full):
        for i, by in enumerate(_multipliers(count)):
            least = np.minimum.reduceat((sets ^ (by >> np.uint64(7))) * by, begin[full])
            out[full, i] = mix(least + _ROLL[:1] * np.uint64(i))
    return out


def fingerprints(sets: np.ndarray, begin: np.ndarray) -> list[bytes]:
    """128 bits per row that are equal for equal sets."""
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(sets * by), dtype=np.uint64)]) for by in _ROLL[:2]]
    pair = np.stack([(s[begin[1:]] - s[begin[:-1]]) ^ np.diff(begin).astype(np.uint64) for s in sums], axis=1)
    return [row.tobytes() for row in np.ascontiguousarray(pair)]
