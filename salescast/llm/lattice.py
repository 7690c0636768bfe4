"""Log-space recursion over all segmentations of a word into the pieces of a byte vocabulary, by numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from salescast.llm.text import mix

#: Words of more bytes are taken one by one.
WIDE = 48
_MUL = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 20


class Lattice:
    """Pieces with natural-log probabilities. Every single byte has to be a piece, so that every word has a path."""

    def __init__(self, pieces: list[bytes], logs: np.ndarray):
        self.pieces, self.logs = pieces, np.append(logs, -np.inf)
        self.number = {p: i for i, p in enumerate(pieces)}
        self.longest = max(map(len, pieces))
        self.keys = np.zeros((1 << _SLOTS) + 64, np.uint64)
        self.ids = np.full(len(self.keys), len(pieces), np.int32)
        for part, text in self._alike(pieces, len(pieces)):
            key = np.zeros(len(part), np.uint64)
            for byte in text:
                key = self._longer(key, byte)
            at = self._slot(key)
            while len(part):  # each free slot goes to one of those that want it, the others move on
                free = self.keys[at] == 0
                _, one = np.unique(at, return_index=True)
                placed = one[free[one]]
                self.keys[at[placed]], self.ids[at[placed]] = key[placed], part[placed]
                rest = np.setdiff1d(np.arange(len(part)), placed, assume_unique=True)
                part, key, at = part[rest], key[rest], at[rest] + 1

    @staticmethod
    def _longer(key: np.ndarray, byte: np.ndarray) -> np.ndarray:
        return (key + byte + np.uint64(1)) * _MUL ^ (key >> np.uint64(29))

    @staticmethod
    def _slot(key: np.ndarray) -> np.ndarray:
        return (mix(key.copy()) >> np.uint64(64 - _SLOTS)).astype(np.int64)

    def _find(self, key: np.ndarray) -> np.ndarray:
        at = self._slot(key)
        out = np.where(self.keys[at] == key, self.ids[at], len(self.pieces))
        left = np.flatnonzero((self.keys[at] != key) & (self.keys[at] != 0))
        while len(left):
            at[left] += 1
            same = self.keys[at[left]] == key[left]
            out[left[same]] = self.ids[at[left[same]]]
            left = left[~same & (self.keys[at[left]] != 0)]
        return out

    def _edges(self, text: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        """For each stretch (start, end) the piece of each word there, or len(pieces); text has a row per byte place."""
        out = {}
        for i in range(len(text)):
            key = np.zeros(text.shape[1], np.uint64)
            for j in range(i, min(len(text), i + self.longest)):
                key = self._longer(key, text[j])
                ids = self._find(key)
                if j == i or (ids != len(self.pieces)).any():
                    out[i, j + 1] = ids
        return out

    @staticmethod
    def _sum(terms: list[np.ndarray]) -> np.ndarray:
        if len(terms) == 1:
            return terms[0]
        terms = np.stack(terms)
        most = terms.max(axis=0)
        return most + np.log(np.exp(terms - most).sum(axis=0))

    def _forward(self, edges: dict, size: int, count: int) -> list[np.ndarray]:
        at = [np.zeros(count)]
        for j in range(1, size + 1):
            at.append(self._sum([at[i] + self.logs[edges[i, j]]
                                 for i in range(max(0, j - self.longest), j) if (i, j) in edges]))
        return at

    def _alike(self, words: list[bytes], most: int = 4096) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Groups of words of one length: their indices, and their bytes with a row per place."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for size in np.unique(sizes):
            which = np.flatnonzero(sizes == size)
            for k in range(0, len(which), most):
                part = which[k: k + most]
                text = np.frombuffer(b"".join(words[i] for i in part), np.uint8).reshape(len(part), size)
                yield part, np.ascontiguousarray(text.T)

    def log_probability(self, words: list[bytes]) -> np.ndarray:
        """Natural log of each word's probability, summed over all its segmentations."""
        out = np.zeros(len(words))
        short = [i for i, w in enumerate(words) if len(w) <= WIDE]
        for part, text in self._alike([words[i] for i in short]):
            found = self._forward(self._edges(text), len(text), text.shape[1])[-1]
            out[np.asarray(short)[part]] = found
        for i, word in enumerate(words):
            if len(word) > WIDE:
                out[i] = self._long(word)[0][-1]
        return out

    def expected(self, words: list[bytes], times: np.ndarray) -> np.ndarray:
        """How often each piece is expected in the words, each taken ``times`` times."""
        mass = np.zeros(len(self.pieces) + 1)
        short = [i for i, w in enumerate(words) if len(w) <= WIDE]
        for part, text in self._alike([words[i] for i in short]):
            size, count = len(text), text.shape[1]
            edges = self._edges(text)
            ahead = self._forward(edges, size, count)
            weight = times[np.asarray(short)[part]]
            behind = [np.zeros(0)] * size + [np.zeros(count)]
            for i in range(size - 1, -1, -1):
                own = [(edges[i, j], self.logs[edges[i, j]] + behind[j])
                       for j in range(i + 1, min(size, i + self.longest) + 1) if (i, j) in edges]
                behind[i] = self._sum([t for _, t in own])
                for ids, tail in own:
                    share = np.exp(ahead[i] + tail - ahead[-1]) * weight
                    mass += np.bincount(ids, share, len(mass))
        for i, word in enumerate(words):
            if len(word) > WIDE:
                self._long(word, mass, times[i])
        return mass[:-1]

    def _long(self, word: bytes, mass: np.ndarray | None = None, times: float = 0) -> tuple[list[float], float]:
        ahead = [0.0] + [-np.inf] * len(word)
        edges = []
        for i in range(len(word)):
            for j in range(i + 1, min(len(word), i + self.longest) + 1):
                piece = self.number.get(word[i:j])
                if piece is not None:
                    ahead[j] = np.logaddexp(ahead[j], ahead[i] + self.logs[piece])
                    edges.append((i, j, piece))
        if mass is not None:
            behind = [-np.inf] * len(word) + [0.0]
            for i, j, piece in reversed(edges):
                tail = self.logs[piece] + behind[j]
                behind[i] = np.logaddexp(behind[i], tail)
                mass[piece] += times * np.exp(ahead[i] + tail - ahead[-1])
        return ahead, ahead[-1]
