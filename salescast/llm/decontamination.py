"""Benchmark decontamination over a distributed positional inverted index of the training documents.

The index is a written table with one row per run of documents (a block of at most ``BLOCK`` bytes of text): the sorted
terms of the block and, for each, the sorted positions of its occurrences. Blocks need no exchange to be built, so a common
word or a hot source never meets in one task.

A search is joins. Terms that no test phrase has are left out of the blocks' terms; of the rest, those of a phrase that
fewest blocks hold lead it. A phrase with a term that no block holds drops out; the others meet the blocks that hold
their leading term, packed to rows of about ``GROUP`` bytes a block. In the block's own task a phrase starts from the
positions of the term rarest there and is intersected, offset by offset, with the lists of the others, the next rarest
first. Phrases stay in tables throughout; nothing is sampled, capped or brought to the driver but their total size.

Edge cases: null and empty texts have no words and hit nothing. Phrases without words are ignored. Rows that repeat
(same id, same or other text) are answered row by row. A null document id stays null. A benchmark row with a null id
still marks words; it is neither counted nor listed. Other columns of either table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.llm.text import LETTERS, Words, runs
from salescast.session import discard, materialize

#: Text bytes of a block, and bytes of the phrases that meet it in one row; both bound what one task holds at once.
BLOCK = 2 << 20
GROUP = 4 << 20

INDEX = "block bigint, ids array<bigint>, first binary, terms binary, lists binary, places binary"
HITS = "block bigint, row int, doc_id bigint, phrase_key bigint, start int, size int"


def positional_index(documents: DataFrame, block: int = BLOCK) -> DataFrame:
    """The written index of ``documents`` (doc_id, text): a row per block.

    ``first`` has the first word of each document, ``terms`` the word hashes in order, ``lists`` where each term's list
    begins in ``places``, all little-endian (u32, u64, u32). ``places`` are steps from one to the next (u32), low bytes of all
    first and high ones last, which a codec makes short.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for rows in runs(batch, "text", block):
                words = Words(rows["text"], LETTERS)
                hashes = words.hashes()
                places = np.argsort(hashes, kind="stable")
                terms, lists = np.unique(hashes[places], return_index=True)
                yield pa.RecordBatch.from_pydict({
                    "block": [number],
                    "ids": pa.array([rows["doc_id"].to_pylist()], pa.list_(pa.int64())),
                    "first": [words.first.astype("<u4").tobytes()],
                    "terms": [terms.astype("<u8").tobytes()],
                    "lists": [np.append(lists, len(places)).astype("<u4").tobytes()],
                    "places": [_packed(places)],
                })
                number += 1

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return materialize(rows.mapInArrow(build, INDEX), "positional-index", compression="zstd")


def _packed(places: np.ndarray) -> bytes:
    steps = np.diff(places, prepend=0).astype("<i4")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i4").ravel(), dtype=np.int64)


class _Block:
    """One row of the index, as arrays."""

    def __init__(self, first: bytes, terms: bytes, lists: bytes, places: bytes):
        self.first = np.frombuffer(first, "<u4").astype(np.int64)
        self.terms, self.lists = np.frombuffer(terms, "<u8"), np.frombuffer(lists, "<u4").astype(np.int64)
        self.places = _unpacked(places)
        # Lists one after the other, each shifted to a range of its own: a sorted set of (term, place).
        self.width = int(self.first[-1]) + 1
        self.keys = np.repeat(np.arange(len(self.terms)), np.diff(self.lists)) * self.width + self.places

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each term here, or -1."""
        if not len(self.terms):
            return np.full(hashes.shape, -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def holds(self, terms: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Whether each term's list has the place."""
        inside = (places >= 0) & (places < self.width - 1)
        wanted = terms * self.width + places
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return inside & (self.keys[at] == wanted)

    def documents(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, places, "right") - 1

    def starts(self, phrases: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Phrases (a row of ``size`` hashes each) that occur, and the places where they start."""
        terms = self.find(phrases)
        kept = np.flatnonzero((terms >= 0).all(axis=1))
        terms = terms[kept]
        often = np.diff(self.lists)[terms]
        order = np.argsort(often, axis=1, kind="stable")
        rarest = order[:, 0] if len(kept) else np.zeros(0, np.int64)
        lead = terms[np.arange(len(kept)), rarest]
        many = np.diff(self.lists)[lead]
        which = np.repeat(np.arange(len(kept)), many)
        within = np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)
        start = self.places[self.lists[lead][which] + within] - rarest[which]
        for rank in range(1, size):
            offset = order[which, rank]
            good = self.holds(terms[which, offset], start + offset) & (start >= 0)
            which, start = which[good], start[good]
        good = start >= 0
        which, start = which[good], start[good]
        whole = self.documents(start) == self.documents(start + size - 1)
        return kept[which[whole]], start[whole]

    def near(self, phrases: np.ndarray, size: int, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``starts``, but any place of the rarest term that has every other term within ``slop`` words."""
        terms = self.find(phrases)
        kept = np.flatnonzero((terms >= 0).all(axis=1))
        which, start = [], []
        for row in kept:
            lists = [self.places[self.lists[t]: self.lists[t + 1]] for t in terms[row]]
            lists.sort(key=len)
            here = lists[0]
            document = self.documents(here)
            low = np.maximum(here - slop, self.first[document])
            high = np.minimum(here + slop, self.first[document + 1] - 1)
            for other in lists[1:]:
                good = np.searchsorted(other, high, "right") > np.searchsorted(other, low)
                here, low, high = here[good], low[good], high[good]
            which.append(np.full(len(here), row))
            start.append(here)
        return np.concatenate(which or [kept]), np.concatenate(start or [kept])


def _windows(benchmark: DataFrame, window: int) -> DataFrame:
    """The windows of each item (item_id, phrase: its word hashes)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in runs(batch, "text"):
                words = Words(rows["text"], LETTERS)
                hashes = words.hashes().astype("<u8")
                ids, phrases = [], []
                for i, item in enumerate(rows["item_id"].to_pylist()):
                    own = hashes[words.first[i]: words.first[i + 1]]
                    for k in range(max(1, len(own) - window + 1) if len(own) else 0):
                        ids.append(item)
                        phrases.append(own[k: k + window].tobytes())
                yield pa.RecordBatch.from_pydict({"item_id": pa.array(ids, pa.string()),
                                                  "phrase": pa.array(phrases, pa.binary())})

    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(cut, "item_id string, phrase binary")


def _phrase_terms(phrases: DataFrame) -> DataFrame:
    """The different terms of each phrase, as (phrase_key, term)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, terms = [], []
            for key, phrase in zip(batch["phrase_key"].to_pylist(), batch["phrase"].to_pylist()):
                own = np.unique(np.frombuffer(phrase, "<i8"))
                keys.append(np.full(len(own), key, np.int64))
                terms.append(own)
            yield pa.RecordBatch.from_pydict({"phrase_key": pa.array(np.concatenate(keys or [np.zeros(0, np.int64)])),
                                              "term": pa.array(np.concatenate(terms or [np.zeros(0, np.int64)]))})

    return phrases.select("phrase_key", "phrase").mapInArrow(cut, "phrase_key bigint, term bigint")


def _block_terms(index: DataFrame) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, terms in zip(batch["block"], batch["terms"]):
                own = np.frombuffer(terms.as_buffer(), "<i8")
                yield pa.RecordBatch.from_pydict({"block": pa.array(np.full(len(own), block.as_py())), "term": pa.array(own)})

    return index.select("block", "terms").mapInArrow(cut, "block bigint, term bigint")


def _meetings(index: DataFrame, phrases: DataFrame, group: int) -> DataFrame:
    """The phrases that may occur in a block, as (block, keys, phrases): a row for about ``group`` bytes of them."""
    parts = materialize(_phrase_terms(phrases), "phrase-terms")
    wanted = materialize(parts.select("term").distinct(), "wanted-terms")
    posted = materialize(_block_terms(index).join(wanted, "term", "left_semi").select("block", "term"), "term-blocks")
    # Written, as a join with an aggregate can't be split where a term is common.
    often = materialize(posted.groupBy("term").agg(F.count(F.lit(1)).alias("often")), "term-counts")
    lead = (parts.join(often, "term", "left").groupBy("phrase_key")
            .agg(F.min(F.struct("often", "term")).alias("lead"), F.bool_and(F.col("often").isNotNull()).alias("whole"))
            .where("whole").select("phrase_key", "lead.term"))
    total = phrases.agg(F.coalesce(F.sum(F.octet_length("phrase")), F.lit(0)).alias("n")).first().n
    part = F.pmod(F.xxhash64("phrase_key"), F.lit(1 + total // group))
    leads = materialize(lead.join(phrases, "phrase_key").withColumn("part", part), "leads")
    return (posted.join(leads, "term").groupBy("block", "part")
            .agg(F.collect_list("phrase_key").alias("keys"), F.collect_list("phrase").alias("phrases")).drop("part"))


def search(index: DataFrame, phrases: DataFrame, slop: int | None = None, group: int = GROUP) -> DataFrame:
    """Every occurrence of the phrases (phrase_key, different for each, and phrase: u64 word hashes) in the index, as ``HITS``.

    Exact phrases by default; with ``slop``, places of a phrase's rarest term that have all its other terms within that
    many words in the same document, in any order. A block meets its phrases in rows of about ``group`` bytes.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch[c][i] for c in batch.schema.names}
                block = _Block(*(row[c].as_buffer() for c in ("first", "terms", "lists", "places")))
                ids, by_size = row["ids"].values, {}
                for key, phrase in zip(row["keys"].as_py(), row["phrases"].as_py()):
                    by_size.setdefault(len(phrase) // 8, []).append((key, phrase))
                for n, own in by_size.items():
                    names = np.array([key for key, _ in own], np.int64)
                    hashes = np.frombuffer(b"".join(phrase for _, phrase in own), "<u8").reshape(-1, n)
                    which, start = (block.starts(hashes, n) if slop is None else block.near(hashes, n, slop))
                    document = block.documents(start)
                    yield pa.RecordBatch.from_pydict({
                        "block": pa.array(np.full(len(which), row["block"].as_py())),
                        "row": pa.array(document.astype(np.int32)),
                        "doc_id": ids.take(pa.array(document)),
                        "phrase_key": pa.array(names[which]),
                        "start": pa.array((start - block.first[document]).astype(np.int32)),
                        "size": pa.array(np.full(len(which), n if slop is None else 1, np.int32)),
                    })

    # Not written: a file of repeated phrases is far shorter than what a broadcast of it would hold.
    return index.join(_meetings(index, phrases, group), "block").mapInArrow(scan, HITS)


def _row_counts(index: DataFrame) -> DataFrame:
    """Every document row with its number of words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, ids, first in zip(batch["block"], batch["ids"], batch["first"]):
                sizes = np.diff(np.frombuffer(first.as_buffer(), "<u4").astype(np.int64))
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array(np.full(len(sizes), block.as_py())),
                    "row": pa.array(np.arange(len(sizes), dtype=np.int32)),
                    "doc_id": ids.values, "n_words": pa.array(sizes)})

    return index.select("block", "ids", "first").mapInArrow(count, "block bigint, row int, doc_id bigint, n_words bigint")


def contamination(documents: DataFrame, benchmark: DataFrame, window: int = 10, block: int = BLOCK,
                  group: int = GROUP) -> DataFrame:
    """Documents against the windows of ``window`` consecutive words of the benchmark items.

    A shorter item is one window. Returns doc_id, n_words, n_hit (words inside an occurrence), n_items, items (the sorted
    ids of items with occurring windows), contaminated; a row per row of ``documents``.
    """
    index = positional_index(documents, block)
    windows = materialize(_windows(benchmark, window)
                          .withColumn("phrase_key", F.xxhash64("phrase")), "test-windows")
    phrases = materialize(windows.select("phrase_key", "phrase").distinct(), "phrases")
    hits = materialize(search(index, phrases, group=group), "window-hits")
    counts = materialize(_row_counts(index), "row-counts")
    discard(index)
    # Overlapping occurrences are merged by stretches: sorted by start, a stretch adds what lies beyond all before it.
    spans = hits.groupBy("block", "row", "start").agg(F.max("size").alias("size"))
    spans = spans.groupBy("block", "row").agg(F.sort_array(F.collect_list(F.struct("start", "size"))).alias("spans"))
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("to")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["start"] + s["size"] - F.greatest(a["to"], s["start"]))).alias("n"),
            F.greatest(a["to"], s["start"] + s["size"]).alias("to")))["n"]
    spans = spans.select("block", "row", covered.alias("n_hit"))
    items = (hits.select("block", "row", "phrase_key").distinct()
             .join(windows.select("phrase_key", "item_id").distinct(), "phrase_key")
             .where("item_id is not null")
             .groupBy("block", "row").agg(F.sort_array(F.collect_set("item_id")).alias("items")))
    found = spans.join(items, ["block", "row"], "left")
    none = F.array().cast("array<string>")
    return (counts.join(found, ["block", "row"], "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("items", none).alias("items"),
                    (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated")))


def phrase_table(spark, phrases: list[str]) -> DataFrame:
    """Phrases given as texts, for ``search``: phrase_key is the place in the list; those without words are left out."""
    words = Words(pa.array(phrases, pa.string()), LETTERS)
    hashes = words.hashes().astype("<u8")
    rows = [(i, bytearray(hashes[a:b].tobytes())) for i, (a, b) in enumerate(zip(words.first, words.first[1:])) if b > a]
    return spark.createDataFrame(rows, "phrase_key bigint, phrase binary")
