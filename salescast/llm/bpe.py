"""Byte-level BPE with an existing vocabulary: overlapping chunks, stitched where their pre-tokens agree again.

A text is cut into chunks of ``CHUNK`` characters, each with ``OVERLAP`` more characters of the next; texts that fit in one
are finished where they are read. Chunks are pre-tokenised and encoded in parallel, each from its own first character. The
pattern looks only ahead, so from a place where two chunks both begin a pre-token they go on alike: there the next chunk
takes over. What a chunk's end may have cut short is never used. Where an overlap holds no common place (one pre-token
longer than it), both chunks are read again as one. Decoding joins the bytes of the ids.

Edge cases: null is the empty text and has no ids. Special tokens are ordinary text. Texts are encoded whole, whatever
their length; ties between merges go to the leftmost pair, as is usual. Repeated rows are encoded row by row. Clashing
columns are no concern, as only ``ids`` is added (a column of that name is replaced).
"""

from __future__ import annotations

import hashlib
import heapq
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.llm.text import runs

CHUNK, OVERLAP = 32_768, 1024
#: Characters that a pre-token's end may depend on beyond it.
AHEAD = 3
#: Pre-tokens whose ids a task remembers at most.
REMEMBERED = 200_000
#: From so many bytes on, pairs are kept in a heap; up to so many, pre-tokens are merged together.
LONG, MATRIX = 200, 48
#: Bytes of text whose pre-tokens are looked up together.
TOGETHER = 2 << 20


class Codec(dict):
    """Maps a pre-token to its ids; remembers the most recent ones.

    New pre-tokens of a run are made unique and merged together, those of one length as rows of a matrix: a round replaces in each row
    the leftmost pair of the least rank. The rank of a pair is that of its joined bytes, and is the id of what it becomes.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.none = max(ranks.values(), default=0) + 1
        self.bytes_of = {rank: piece for piece, rank in ranks.items()}
        self.shown = [str(rank).encode() for rank in range(self.none)]
        self.single = np.array([ranks.get(bytes([b]), -1) for b in range(256)])
        pairs = sorted((ranks[piece[:k]] * self.none + ranks[piece[k:]], rank) for piece, rank in ranks.items()
                       for k in range(1, len(piece)) if piece[:k] in ranks and piece[k:] in ranks)
        self.pairs, self.joined = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else (np.array([-1]), np.array([0]))

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, ``none`` if they don't join."""
        key = left * self.none + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.joined[at], self.none)

    def _merged(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of pieces of one length."""
        size = len(pieces[0])
        ids = self.single[np.frombuffer(b"".join(pieces), np.uint8).reshape(-1, size)].astype(np.int64)
        out, own = [()] * len(pieces), np.arange(len(pieces))
        rank = self._rank(ids[:, :-1], ids[:, 1:])
        while len(own):
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(own), np.int64)
            best = rank[np.arange(len(own)), at] if rank.shape[1] else np.full(len(own), self.none)
            done = best == self.none
            for i, row in zip(own[done].tolist(), ids[done].tolist()):
                out[i] = tuple(row)
            own, ids, rank, at, best = own[~done], ids[~done], rank[~done], at[~done], best[~done]
            row, width = np.arange(len(own)), ids.shape[1]
            ids[row, at] = best
            keep = np.arange(width - 1)
            ids = np.take_along_axis(ids, keep + (keep > at[:, None]), 1)
            # The joined pair's rank goes; its neighbours' are looked up anew.
            keep = keep[:-1]
            rank = np.take_along_axis(rank, keep + (keep >= at[:, None]), 1)
            after = np.flatnonzero(at < width - 2)
            rank[after, at[after]] = self._rank(ids[after, at[after]], ids[after, at[after] + 1])
            before = np.flatnonzero(at > 0)
            rank[before, at[before] - 1] = self._rank(ids[before, at[before] - 1], ids[before, at[before]])
        return out

    def learn(self, tokens: set[str]) -> None:
        """See to it that ``tokens`` are remembered, but for long ones, which are looked up one by one."""
        new = tokens.difference(self)
        if len(self) + len(new) > REMEMBERED:
            self.clear()
            new = tokens
        by_size: dict[int, tuple[list[str], list[bytes]]] = defaultdict(lambda: ([], []))
        get = self.ranks.get
        for token in new:
            piece = token.encode()
            if (whole := get(piece)) is not None:
                self[token] = (whole,)
            elif (size := len(piece)) <= MATRIX:
                own = by_size[size]
                own[0].append(token)
                own[1].append(piece)
        for names, pieces in by_size.values():
            self.update(zip(names, self._merged(pieces)))

    def __missing__(self, token: str) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        piece = token.encode()
        whole = self.ranks.get(piece)
        out = (whole,) if whole is not None else tuple(self._short(piece) if len(piece) < LONG else self._long(piece))
        if len(piece) < LONG:
            self[token] = out
        return out

    def _short(self, piece: bytes) -> list[int]:
        get, none = self.ranks.get, len(self.ranks) + (1 << 32)
        parts = [piece[i: i + 1] for i in range(len(piece))]
        pairs = [get(piece[i: i + 2], none) for i in range(len(piece) - 1)]
        while pairs:
            best = min(pairs)
            if best == none:
                break
            i = pairs.index(best)
            parts[i: i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], none)
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], none)
        return [self.ranks[p] for p in parts]

    def _long(self, piece: bytes) -> list[int]:
        get = self.ranks.get
        size = len(piece)
        end = list(range(1, size + 1))  # the part that begins at i ends before end[i]; 0: there is none
        before = list(range(-1, size - 1))
        heap = [(rank, i, i + 2) for i in range(size - 1) if (rank := get(piece[i: i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, to = heapq.heappop(heap)
            middle = end[i]
            if not middle or middle >= size or end[middle] != to:
                continue  # one of the two has been merged since
            end[i], end[middle] = to, 0
            if to < size:
                before[to] = i
                if (rank := get(piece[i: end[to]])) is not None:
                    heapq.heappush(heap, (rank, i, end[to]))
            if (left := before[i]) >= 0 and (rank := get(piece[left: to])) is not None:
                heapq.heappush(heap, (rank, left, to))
        return [self.ranks[piece[i: end[i]]] for i in range(size) if end[i]]

    def found(self, texts: list[str]) -> list[list[str]]:
        """The pre-tokens of each text, all of them learnt."""
        out = list(map(self.pattern.findall, texts))
        self.learn(set(chain.from_iterable(out)))
        return out

    def all_ids(self, texts: list[str]) -> Iterator[array]:
        """The ids of each text."""
        for tokens in self.found(texts):
            yield array("i", list(chain.from_iterable(map(self.__getitem__, tokens))))

    def all_pieces(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of each text, where each pre-token begins, how many ids it has, and all ids."""
        for tokens in self.found(texts):
            size = np.fromiter(map(len, tokens), np.int64, len(tokens))
            ids = list(map(self.__getitem__, tokens))
            yield (np.cumsum(size) - size, np.fromiter(map(len, ids), np.int64, len(ids)), np.fromiter(chain.from_iterable(ids), np.int32))

    def pieces(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return next(self.all_pieces([text]))


_kept: Codec | None = None


def _codec(known: tuple[dict[bytes, int], str]) -> Codec:
    """The codec of a vocabulary and pattern; a Python worker keeps the last one, with what it remembers, for its next tasks."""
    global _kept
    if _kept is None or _kept.ranks is not known[0] or _kept.pattern.pattern != known[1]:
        _kept = Codec(*known)
    return _kept


def _id_lists(found: Iterator[array]) -> pa.Array:
    at, flat = array("i", [0]), array("i")
    for ids in found:
        flat.extend(ids)
        at.append(len(flat))
    return pa.ListArray.from_arrays(pa.array(np.frombuffer(at, np.int32)), pa.array(np.frombuffer(flat, np.int32)))


DIGESTS = pa.struct([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def _digests(codec: Codec, found: Iterator[array]) -> pa.Array:
    """Number and hash of the ids of each text, and the hash of the bytes that they decode to."""
    out = []
    for ids in found:
        shown, decoded = b",".join(map(codec.shown.__getitem__, ids)), b"".join(map(codec.bytes_of.__getitem__, ids))
        out.append((len(ids), hashlib.sha256(shown).hexdigest(), hashlib.sha256(decoded).hexdigest()))
    return pa.array([dict(zip(DIGESTS.names, one)) for one in out], DIGESTS)


class _Chunk:
    """Pre-tokens of a chunk: their absolute places, and ids."""

    def __init__(self, begin: int, text: str, starts: np.ndarray, counts: np.ndarray, ids: np.ndarray):
        self.begin, self.text, self.ids = begin, text, ids
        self.starts, self.at = starts + begin, np.concatenate([[0], np.cumsum(counts)])

    @property
    def end(self) -> int:
        return self.begin + len(self.text)

    def between(self, low: int, high: int | None) -> np.ndarray:
        """Ids of the pre-tokens that begin in [low, high)."""
        a = np.searchsorted(self.starts, low)
        b = len(self.starts) if high is None else np.searchsorted(self.starts, high)
        return self.ids[self.at[a]: self.at[b]]


def stitch(chunks: list[_Chunk], codec: Codec) -> np.ndarray:
    """The ids of a text from its chunks in order."""
    out, now, trusted = [], chunks[0], chunks[0].begin
    for after in chunks[1:]:
        sure = now.starts[(now.starts >= trusted) & (now.starts <= now.end - AHEAD)]
        common = sure[np.isin(sure, after.starts)]
        if len(common):
            out.append(now.between(trusted, common[0]))
            now, trusted = after, int(common[0])
        else:
            text = now.text[trusted - now.begin:] + after.text[now.end - after.begin:]
            now = _Chunk(trusted, text, *codec.pieces(text))
    out.append(now.between(trusted, None))
    return np.concatenate(out)


def _over_texts(documents: DataFrame, ranks: dict[bytes, int], pattern: str, chunk: int, overlap: int, kind: str,
                finish: Callable[[Codec, Iterator[array]], pa.Array]) -> DataFrame:
    """The columns of ``documents`` but ``text``, and ``found`` of type ``kind``: what ``finish`` makes of the ids of whole texts."""
    known = documents.sparkSession.sparkContext.broadcast((ranks, pattern))  # a vocabulary of fixed size
    others = [c for c in documents.columns if c != "text"]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = documents.select(F.struct(*others).alias("rest") if others else F.struct(F.lit(0)).alias("rest"), text.alias("text"))
    short = F.length("text") <= chunk + overlap

    @F.arrow_udf(kind)
    def whole(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = _codec(known.value)
        for texts in column:
            parts = runs(pa.RecordBatch.from_arrays([texts], ["text"]), "text", TOGETHER)
            yield finish(codec, chain.from_iterable(codec.all_ids(part["text"].to_pylist()) for part in parts))

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(known.value)
        for batch in batches:
            for some in runs(batch, "text", TOGETHER):
                for i, (starts, counts, ids) in enumerate(codec.all_pieces(some["text"].to_pylist())):
                    row = some.slice(i, 1)
                    new = [starts.astype("<u4").tobytes(), counts.astype("<u4").tobytes(), ids.astype("<i4").tobytes()]
                    yield pa.RecordBatch.from_arrays([*row.columns, *(pa.array([x], pa.binary()) for x in new)],
                                                     [*row.schema.names, "starts", "counts", "ids"])

    def join(parts: pa.Table) -> pa.Table:
        parts, codec = parts.sort_by("number"), _codec(known.value)
        read = lambda c, i: np.frombuffer(parts[c][i].as_buffer(), "<i4").astype(np.int64)
        chunks = [_Chunk(parts["number"][i].as_py() * chunk, parts["text"][i].as_py(), read("starts", i), read("counts", i),
                         np.frombuffer(parts["ids"][i].as_buffer(), "<i4")) for i in range(parts.num_rows)]
        ids = array("i", stitch(chunks, codec).astype("<i4").tobytes())
        return pa.table({"rest": parts["rest"].slice(0, 1).combine_chunks(), "found": finish(codec, iter([ids]))})

    rest = rows.schema["rest"].dataType.simpleString()
    chunks = (rows.withColumn("key", F.monotonically_increasing_id()).where(~short)
              .withColumn("number", F.explode(F.sequence(
                  F.lit(0), F.ceil((F.length("text") - overlap) / chunk).cast("int") - 1)))
              .select("key", "number", F.when(F.col("number") == 0, F.col("rest")).alias("rest"),
                      F.expr(f"substring(text, number * {chunk} + 1, {chunk + overlap})").alias("text")))
    columns = f"key bigint, number int, rest {rest}, text string"
    parts = chunks.repartition("key", "number").mapInArrow(part, f"{columns}, starts binary, counts binary, ids binary")
    long = parts.groupBy("key").applyInArrow(join, f"rest {rest}, found {kind}")
    out = rows.where(short).select("rest", whole("text").alias("found")).unionByName(long)
    return out.select(*([F.col("rest")[c].alias(c) for c in others]), "found")


def encode(documents: DataFrame, ranks: dict[bytes, int], pattern: str, chunk: int = CHUNK,
           overlap: int = OVERLAP) -> DataFrame:
    """The columns of ``documents`` but ``text``, and ``ids``: the ids (array of int) of each whole text."""
    documents = documents.drop("ids")
    return _over_texts(documents, ranks, pattern, chunk, overlap, "array<int>", lambda codec, found: _id_lists(found)).select(
        *(c for c in documents.columns if c != "text"), F.col("found").alias("ids"))


def round_trip(documents: DataFrame, ranks: dict[bytes, int], pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """The columns of ``documents`` but ``text``, and ``n_tokens``, ``ids_sha256`` and ``decoded_sha256``.

    Encodes each whole text and decodes its ids where they are made, so that neither are sent on.
    """
    documents = documents.drop(*DIGESTS.names)
    kind = "struct<n_tokens: bigint, ids_sha256: string, decoded_sha256: string>"
    found = _over_texts(documents, ranks, pattern, chunk, overlap, kind, _digests)
    return found.select(*(c for c in documents.columns if c != "text"), "found.*")


def decode(rows: DataFrame, ranks: dict[bytes, int], ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``rows`` with the column ``to``: the bytes that the ids stand for, null where these are null."""
    pieces = rows.sparkSession.sparkContext.broadcast({rank: piece for piece, rank in ranks.items()})
    rows = rows.drop(to)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = pieces.value.__getitem__
        for batch in batches:
            done, size, out = 0, 0, []
            for i, own in enumerate(batch[ids]):
                out.append(None if own.as_py() is None else b"".join(map(get, own.as_py())))
                size += len(out[-1] or b"")
                if size >= TOGETHER or i + 1 == batch.num_rows:  # long texts are sent on before the batch ends
                    yield batch.slice(done, len(out)).append_column(to, pa.array(out, pa.binary()))
                    done, size, out = i + 1, 0, []

    return rows.mapInArrow(join, T.StructType([*rows.schema, T.StructField(to, T.BinaryType())]))
