"""Words and their hashes for whole Arrow text batches, by numpy.

Both word patterns of this package are sets of ASCII bytes that end a word, so they can be found in the UTF-8
bytes themselves; bytes of characters beyond ASCII always belong to words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"): ord("Z") + 1] += 32

#: Bytes of words `[^\x20\x09-\x0D]+`.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: Bytes of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` once A-Z is lower-cased.
LETTERS = np.zeros(256, dtype=bool)
LETTERS[ord("0"): ord("9") + 1] = LETTERS[ord("a"): ord("z") + 1] = LETTERS[0x80:] = True

_LANE = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def unused(rows: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``rows`` does not have, in any case of letters."""
    taken = {c.lower() for c in rows.columns}
    while name in taken:
        name += "_"
    return name


def mix(x: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit permutation of each value; works in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def runs(rows: pa.RecordBatch | pa.Table, column: str, most: int = 16 << 20) -> Iterator[pa.RecordBatch | pa.Table]:
    """Consecutive rows with at most ``most`` bytes of text together, or one row that is longer."""
    size = np.cumsum(pc.fill_null(pc.binary_length(rows[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = done = 0
    while at < rows.num_rows:
        to = max(at + 1, int(np.searchsorted(size, done + most, "right")))
        yield rows.slice(at, to - at)
        at, done = to, int(size[to - 1])


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the place where each row begins, with the end as last; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    at = at[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return data[at[0]: at[-1]], at - at[0]


class Words:
    """The words of a text column, A-Z lower-cased.

    ``first[i]`` to ``first[i + 1]`` are the words of row i; ``start`` and ``end`` their places in ``data``.
    """

    def __init__(self, column: pa.Array, kind: np.ndarray):
        data, at = raw(column)
        self.data = np.concatenate([LOWER[data], np.zeros(8, np.uint8)])
        inside = np.zeros(len(data) + 2, dtype=bool)
        inside[1:-1] = kind[self.data[: len(data)]]
        here = inside[1:-1]
        begins, ends = here & ~inside[:-2], here & ~inside[2:]
        edge = at[:-1][at[:-1] < len(data)]
        begins[edge] |= here[edge]
        edge = at[1:][at[1:] > 0] - 1
        ends[edge] |= here[edge]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, at)

    def __len__(self) -> int:
        return len(self.start)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]: self.end[i]].tobytes()

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word, over all its bytes in lanes of eight."""
        lanes = np.ndarray((len(self.data) - 7,), "<u8", self.data, strides=(1,))
        size = self.end - self.start
        out = mix((lanes[self.start] & _LANE[np.minimum(size, 8)]) + size.astype(np.uint64) * _STEP)
        left, lane = np.flatnonzero(size > 8), 8
        while len(left):
            more = lanes[self.start[left] + lane] & _LANE[np.minimum(size[left] - lane, 8)]
            out[left] = mix((out[left] ^ more) + _STEP)
            lane += 8
            left = left[size[left] > lane]
        return out

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """One index for each different word, and for each word the number of its kind among these."""
        _, sample, kind = np.unique(self.hashes(), return_index=True, return_inverse=True)
        return sample, kind

    def binary(self, which: np.ndarray) -> pa.Array:
        """The bytes of the given words as an Arrow column."""
        size = (self.end - self.start)[which]
        at = np.zeros(len(which) + 1, np.int64)
        np.cumsum(size, out=at[1:])
        place = np.arange(at[-1]) + np.repeat(self.start[which] - at[:-1], size)
        buffers = [None, pa.py_buffer(at), pa.py_buffer(np.ascontiguousarray(self.data[place]))]
        return pa.Array.from_buffers(pa.large_binary(), len(which), buffers).cast(pa.binary())
