"""The gap-weighted subsequence kernel between many short strings and a few landmarks, by numpy.

``K(s, t)`` sums, over all subsequences of ``LENGTH`` characters that s and t share, ``DECAY`` to the power of the
stretches that they span in both. Inserted characters lengthen a stretch and so weaken a match, but do not end it.
"""

from __future__ import annotations

import numpy as np

LENGTH = 4
DECAY = 0.7
#: Longer strings are taken as overlapping windows of this many characters.
WIDEST = 24


def windows(fragment: str) -> list[str]:
    """The fragment, or windows of ``WIDEST`` characters at every half of that."""
    half = WIDEST // 2
    return [fragment] if len(fragment) <= WIDEST else [
        fragment[k: k + WIDEST] for k in range(0, len(fragment) - half, half)]


def _codes(strings: list[str], width: int) -> np.ndarray:
    """Code points, a row per string, padded with 0."""
    flat = np.frombuffer("".join(s.ljust(width, "\0") for s in strings).encode("utf-32-le", "surrogatepass"), np.uint32)
    return flat.reshape(len(strings), width)


def kernel(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """K of each pair of rows; codes of 0 on the left and -1 on the right match nothing."""
    n, a, b = len(left), left.shape[1], right.shape[1]
    left, right = np.ascontiguousarray(left.T), np.ascontiguousarray(right.T)
    square = DECAY * DECAY
    total = np.zeros(n)
    # before[i][j]: suffix-weighted matches of i characters that end before place j on the right, for the left so far.
    before = [np.ones((b + 1, n))] + [np.zeros((b + 1, n)) for _ in range(LENGTH - 1)]
    for x in range(a):
        match = (right == left[x]) & (left[x] > 0)
        if not match.any():
            for level in before[1:]:
                level *= DECAY
            continue
        total += square * (before[LENGTH - 1][:b] * match).sum(axis=0)
        for i in range(LENGTH - 1, 0, -1):
            gain = square * before[i - 1][:b] * match
            for j in range(1, b):
                gain[j] += DECAY * gain[j - 1]
            before[i] *= DECAY
            before[i][1:] += gain
    return total


class Landmarks:
    """Landmark strings of at most 16 characters, ready to be compared with many others."""

    def __init__(self, strings: list[str]):
        self.strings = strings
        width = max(map(len, strings))
        self.alphabet = np.unique(np.frombuffer("".join(strings).encode("utf-32-le"), np.uint32))
        codes = self._number(_codes(strings, width))
        self.codes = np.where(codes > 0, codes, -1)
        self.bits = np.zeros((len(self.alphabet) + 1, len(strings)), np.uint16)
        for j, row in enumerate(self.codes):
            for place, code in enumerate(row):
                if code > 0:
                    self.bits[code, j] |= 1 << place
        self.scale = 1 / np.sqrt(kernel(codes, self.codes))

    def _number(self, codes: np.ndarray) -> np.ndarray:
        """Code points as places in the landmarks' alphabet from 1; all others are 0."""
        at = np.minimum(np.searchsorted(self.alphabet, codes), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == codes, at + 1, 0).astype(np.int16)

    def _common(self, codes: np.ndarray) -> np.ndarray:
        """Length of the longest common subsequence of each string with each landmark."""
        state = np.full((len(codes), len(self.strings)), 0xFFFF, np.uint16)
        for column in codes.T:
            bits = self.bits[column]
            hit = state & bits
            state = (state + hit) | (state & ~bits)
        return np.bitwise_count(~state)

    def compare(self, strings: list[str], most: int = 8192) -> np.ndarray:
        """The normalised kernel of each string (``WIDEST`` characters at most) with each landmark."""
        out = np.zeros((len(strings), len(self.strings)), np.float32)
        sizes = np.fromiter(map(len, strings), np.int64, len(strings))
        for size in np.unique(sizes):
            same = np.flatnonzero(sizes == size)
            for k in range(0, len(same), most):
                part = same[k: k + most]
                points = _codes([strings[i] for i in part], int(size))
                codes = self._number(points)
                row, mark = np.nonzero(self._common(codes) >= LENGTH)  # all other pairs share no subsequence
                if not len(row):
                    continue
                touched, back = np.unique(row, return_inverse=True)
                own = points[touched].astype(np.int64)
                norm = np.sqrt(kernel(own, own))
                value = np.concatenate([kernel(codes[row[q: q + most]], self.codes[mark[q: q + most]])
                                        for q in range(0, len(row), most)])
                out[part[row], mark] = value * self.scale[mark] / norm[back]
        return out
