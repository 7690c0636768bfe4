"""Subword lattice language model: a text's probability summed over all segmentations into an existing vocabulary.

The vocabulary is a byte-level one with ranks; it is not trained. Its unigram scores start from the ranks (a lower rank
weighs more) and are re-estimated on the training documents by expected counts over all segmentations. A word is the bytes
of a space and itself, so that pieces never cross words; a text is its words and one end symbol. Its probability is the
product of theirs, and a word's comes from one forward recursion in log space per distinct word of the corpus.

Texts are turned once into blocks of word numbers, each block with its own list of distinct words. Only these lists are
shuffled, once to count words and once for the join that brings each word's count and score, made once, back to the blocks.

Edge cases: null and empty texts are one end token. Without training documents all pieces weigh the same and all counts are
0. A null doc_id counts as a training document. Repeated rows count and are answered row by row. Texts of any length are
read whole; a word of over ``lattice.WIDE`` bytes runs through the same recursion by itself. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.llm.lattice import Lattice
from salescast.llm.text import SPACED, Words, runs
from salescast.session import materialize

#: Text bytes of a block; a larger one has fewer words in common with others.
BLOCK = 8 << 20

BLOCKS = ("block bigint, ids array<bigint>, held_out array<boolean>, first binary, seen bigint, numbers binary,"
          " words array<struct<word: binary, n: bigint>>")
SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double,"
          " score double")


def _pack(numbers: np.ndarray) -> bytes:
    """Word numbers as four byte planes, compressed; frequent words have low numbers."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack(packed: bytes, count: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, 4 * count, codec="zstd"), np.uint8).reshape(4, count)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _blocks(documents: DataFrame, held_out: Column, block: int) -> DataFrame:
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for rows in runs(batch, "text", block):
                words = Words(rows["text"], SPACED)
                sample, kind = words.distinct()
                order = np.argsort(-np.bincount(kind, minlength=len(sample)), kind="stable")
                place = np.empty_like(order)
                place[order] = np.arange(len(order))
                kind = place[kind]
                held = rows["held_out"].to_numpy(zero_copy_only=False).astype(bool)
                times = np.bincount(kind[~held[words.rows()]], minlength=len(sample))
                lists = pa.StructArray.from_arrays([words.binary(sample[order]), pa.array(times, pa.int64())],
                                                   ["word", "n"])
                yield pa.RecordBatch.from_pydict({
                    "block": [number],
                    "ids": pa.array([rows["doc_id"].to_pylist()], pa.list_(pa.int64())),
                    "held_out": pa.array([held.tolist()], pa.list_(pa.bool_())),
                    "first": [words.first.astype("<u4").tobytes()],
                    "seen": [len(words)],
                    "numbers": [_pack(kind)],
                    "words": pa.ListArray.from_arrays(pa.array([0, len(sample)], pa.int32()), lists),
                })
                number += 1

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                            F.coalesce(held_out, F.lit(False)).alias("held_out"))
    return materialize(rows.mapInArrow(build, BLOCKS), "word-blocks")


def _estimate(counts: DataFrame, pieces: list[bytes], ends: int, rounds: int) -> tuple[np.ndarray, float]:
    """Natural-log probabilities of the pieces and of the end symbol, after ``rounds`` of expected counts.

    The driver gathers one number per piece of the vocabulary, whose size is fixed.
    """
    logs = -np.log(np.arange(len(pieces)) + 256.0)
    logs -= np.log(np.exp(logs).sum())
    end = 0.0
    for _ in range(rounds):
        model = counts.sparkSession.sparkContext.broadcast((pieces, logs))

        def expect(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            lattice = Lattice(*model.value)
            mass = np.zeros(len(lattice.pieces))
            for batch in batches:
                words = [b" " + w for w in batch["word"].to_pylist()]
                mass += lattice.expected(words, batch["n"].to_numpy().astype(float))
            some = np.flatnonzero(mass)
            yield pa.RecordBatch.from_pydict({"piece": pa.array(some.astype(np.int32)), "mass": pa.array(mass[some])})

        found = (counts.where("n > 0").select("word", "n").mapInArrow(expect, "piece int, mass double")
                 .groupBy("piece").agg(F.sum("mass").alias("mass"))).toArrow()
        mass = np.ones(len(pieces))
        mass[found["piece"].to_numpy()] += found["mass"].to_numpy()
        total = mass.sum() + ends + 1
        logs, end = np.log(mass / total), float(np.log((ends + 1) / total))
    return logs, end


def lattice_scores(documents: DataFrame, ranks: dict[bytes, int], held_out: Column, rounds: int = 1,
                   block: int = BLOCK) -> DataFrame:
    """Scores of all documents (doc_id, text), learned from those not ``held_out``.

    Returns ``SCORES``: n_tokens counts words and the end, n_known those that occur in training, train_tokens all training
    tokens; base_score is the add-one unigram log10 probability of words, score the lattice model's log10 probability.
    """
    pieces = [p for p, _ in sorted(ranks.items(), key=lambda x: x[1])]
    blocks = _blocks(documents, held_out, block)
    lists = blocks.select("block", F.posexplode("words").alias("place", "w")).select("block", "place", "w.word", "w.n")
    counts = materialize(lists.groupBy("word").agg(F.sum("n").alias("n")), "words")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count_if(F.col("n") > 0).alias("kinds")).first()
    ends = blocks.select(F.sum(F.size(F.filter("held_out", lambda h: ~h)).cast("long")).alias("n")).first().n or 0
    logs, end = _estimate(counts, pieces, ends, rounds)
    model = documents.sparkSession.sparkContext.broadcast((pieces, logs))

    @F.arrow_udf("double")
    def score(words: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lattice = Lattice(*model.value)
        for batch in words:
            yield pa.array(lattice.log_probability([b" " + w for w in batch.to_pylist()]) / np.log(10))

    # Every word is scored once. Joined back, a common word has a row for each block; adaptive execution splits such words.
    scored = materialize(counts.select("word", "n", score("word").alias("log10")), "word-scores")
    own = lists.select(F.col("block").alias("of"), "place", "word")  # another name than that of the blocks it goes back to
    values = own.join(scored, "word").select("of", "place", "n", "log10")
    tokens, kinds = total.tokens + ends, total.kinds + (ends > 0)

    def finish(rows: pa.Table, words: pa.Table) -> pa.Table:
        place = words["place"].to_numpy()
        n, log10 = np.zeros(len(place), np.int64), np.zeros(len(place))
        n[place], log10[place] = words["n"].to_numpy(), words["log10"].to_numpy()
        base = np.log10((n + 1) / (tokens + kinds + 1))
        out = []
        for row in rows.to_batches():
            for i in range(row.num_rows):
                first = np.frombuffer(row["first"][i].as_buffer(), "<u4").astype(np.int64)
                kind = _unpack(row["numbers"][i].as_buffer(), row["seen"][i].as_py())
                size = np.diff(first)
                at = np.repeat(np.arange(len(size)), size)
                add = lambda v: np.bincount(at, v[kind], len(size))
                out.append(pa.table({
                    "doc_id": row["ids"][i].values, "held_out": row["held_out"][i].values, "n_tokens": pa.array(size + 1),
                    "n_known": pa.array(add((n > 0).astype(float)).astype(np.int64) + (ends > 0)),
                    "train_tokens": pa.array(np.full(len(size), tokens)),
                    "base_score": pa.array(add(base) + np.log10((ends + 1) / (tokens + kinds + 1))),
                    "score": pa.array(add(log10) + end / np.log(10)),
                }))
        return pa.concat_tables(out).combine_chunks() if out else pa.table(
            {f: pa.array([], t) for f, t in (("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                                             ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                                             ("base_score", pa.float64()), ("score", pa.float64()))})

    return (blocks.select("block", "ids", "held_out", "first", "seen", "numbers").groupBy("block")
            .cogroup(values.groupBy("of")).applyInArrow(finish, SCORES))
