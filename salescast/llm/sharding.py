"""Shards of bounded bytes by extendible hashing, with DataFrame functions only.

A row's hash has ``BITS`` bits. A directory is indexed by its first bits; only a bucket that holds more bytes than the limit
is split on one more bit, until every shard fits. So a shard is a prefix of the hash, of its own depth.

Bytes are counted once per directory entry (a prefix as deep as the whole needs and ``SLACK`` bits more) and summed up the
tree; an entry belongs to its shallowest ancestor that fits. Entries that are too large themselves are hot keys or very long
rows: only their rows are counted again, some bits deeper. Counting is a combinable aggregate, no row carries its text, and
what a join looks rows up in is the directory, not the rows. All tasks may hold a round of up to ``HELD`` entries; a larger
one is joined by a shuffle on entries, which are bits of a hash and so spread rows evenly, but for hot keys, whose rows
adaptive execution splits.

Rows of one key share the first ``KEY_BITS`` bits, and no split of them could part a hot key; below come bits of the text and
of the row's place, which deal out its rows. A row beyond the limit is a shard of its own.

Edge cases: null and empty keys and texts are values like others, a null text has no bytes. An empty table has no shards. If
all rows fit, they are shard "" of depth 0. Every row of the input gets one shard, repeated ones too; columns of the input
called like added ones are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.session import materialize

KEY_BITS, ROW_BITS = 32, 28
BITS = KEY_BITS + ROW_BITS
#: Bits that the directory is deeper than the shards of evenly spread rows, and bits of each later round.
SLACK, STEP = 3, 6
#: Entries of a round that every task may hold, of 24 bytes each.
HELD = 1 << 17
#: Bytes of text in a shard.
LIMIT = 64 << 20


def _first(bits: Column | int, of: Column | str = "hash", out_of: int = BITS) -> Column:
    return F.call_function("shiftright", F.col(of) if isinstance(of, str) else of, (F.lit(out_of) - bits).cast("int"))


def with_hash(rows: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """``rows`` with ``bytes`` of the text and ``hash``: bits of the keys, then bits of the row."""
    key = F.concat_ws("\x1f", *(F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")) for c in keys))
    key = F.conv(F.substring(F.md5(key.cast("binary")), 1, KEY_BITS // 4), 16, 10).cast("long")
    row = F.call_function("shiftrightunsigned", F.xxhash64(F.col(text).cast("string"), F.monotonically_increasing_id()),
                          F.lit(64 - ROW_BITS))
    return (rows.withColumn("hash", F.call_function("shiftleft", key, F.lit(ROW_BITS)).bitwiseOR(row))
            .withColumn("bytes", F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long")))


def directory(rows: DataFrame, limit: int = LIMIT) -> list[tuple[int, DataFrame]]:
    """The directory of ``rows`` (hash, bytes), in rounds: the bits of an entry, and entry, depth, shard_bytes.

    The depth is null for entries whose rows the next round tells apart.
    """
    total = rows.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("n")).first().n
    out, above = [], 0
    bits = min(KEY_BITS, max(1, math.ceil(math.log2(max(1, total / limit))) + SLACK))
    while True:
        entries = materialize(rows.groupBy(_first(bits).alias("entry")).agg(
            F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows")), "entries")
        tree = entries.withColumn("depth", F.explode(F.sequence(F.lit(above), F.lit(bits)))).withColumn(
            "node", _first(F.col("depth"), "entry", bits))
        sums = tree.groupBy("depth", "node").agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("n"))
        fits = sums.where((F.col("shard_bytes") <= limit) | (F.col("n") == 1) | (F.col("depth") == BITS))
        best = (tree.select("entry", "depth", "node").join(fits, ["depth", "node"])
                .groupBy("entry").agg(F.min(F.struct("depth", "shard_bytes")).alias("best")))
        known = materialize(entries.select("entry").join(best, "entry", "left").select("entry", "best.depth", "best.shard_bytes"),
                            "directory")
        out.append((bits, known))
        large = known.where("depth is null").select("entry")
        if large.isEmpty():
            return out
        rows = rows.join(large, _first(bits) == large["entry"], "left_semi")
        above, bits = bits + 1, min(BITS, bits + STEP)


def shards(rows: DataFrame, keys: list[str], limit: int = LIMIT, text: str = "text") -> DataFrame:
    """``rows`` with ``bytes``, ``shard`` (the bits of its prefix), ``depth`` and ``shard_bytes``."""
    rows = with_hash(rows, keys, text)
    rounds = directory(materialize(rows.select("hash", "bytes"), "hashes"), limit)
    out, left = None, rows
    for number, (bits, known) in enumerate(rounds):
        if known.count() > HELD:
            known = known.hint("merge")
        found = left.drop("depth", "shard_bytes").join(known, _first(bits) == known["entry"]).drop("entry")
        done = found.where("depth is not null") if number + 1 < len(rounds) else found
        out = done if out is None else out.unionByName(done)
        left = found.where("depth is null")
    prefix = F.lpad(F.bin(_first(F.col("depth"))), F.col("depth"), F.lit("0"))
    shard = F.when(F.col("depth") == 0, F.lit("")).otherwise(prefix)
    return out.withColumn("shard", shard).drop("hash")


def write_shards(rows: DataFrame, keys: list[str], path: str, limit: int = LIMIT, text: str = "text") -> None:
    """Write ``rows`` as Parquet below ``path``, a folder ``shard=...`` for each shard; each is written by one task."""
    found = shards(rows, keys, limit, text).withColumn("shard", F.concat(F.lit("s"), "shard"))
    found.repartition("shard").drop("bytes", "depth", "shard_bytes").write.partitionBy("shard").parquet(path)
