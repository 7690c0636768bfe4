"""Near-duplicate documents by an inverted join on the coordinates of MinHash signatures.

A document is the set of its distinct word shingles. Documents with equal sets are one class from the start, so copies
never meet again. A class is posted under each (coordinate, value) of its signature of ``COORDINATES`` values. Two classes
are a candidate pair if they collide in at least ``MATCHES`` coordinates, so they share one of their
``COORDINATES - MATCHES + 1`` rarest postings: only these prefixes are joined, the long lists of frequent values are
skipped there. Postings of one class alone can't collide; a class with fewer than ``MATCHES`` others drops out.

Classes that are connected by prefix postings form a group. In a group collisions are counted over all coordinates, pairs
above the threshold are confirmed on their full sets, and each work unit returns a spanning forest of its links, never
all pairs. A large group is cut into blocks of about ``BLOCK`` classes: first each block by itself; then, only where the
links found so far leave a group in more than one component, classes of different components. In a group of up to
``DENSE`` blocks these meet block by block. A larger one may be a long chain of classes that share little, so there only
classes meet that one prefix posting names: in pairs from a list of up to ``SHORT`` classes, whose collisions are counted
on their signatures before their sets are fetched; a longer list is dealt out in blocks of its own. Lists within one
component are skipped. So a group of thousands of copies costs work in proportion to its size, a chain in proportion to its
lists, and yet no link between different components is left out: both ways find every pair of them with ``MATCHES``
collisions. A pair at a similarity of 0.85 falls below ``MATCHES`` of ``COORDINATES`` collisions with a probability under
1e-8, at 0.8 under 5e-6.

Edge cases: null and empty texts, and those without words, have no shingles and are linked with nothing; component_id is
their own doc_id. A null doc_id is never kept and is passed over for component_id unless its component has no other.
Repeated rows (same id) are answered row by row. Other columns are not read.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.llm.components import components
from salescast.llm.minhash import fingerprints, shingle_sets, signatures
from salescast.llm.text import runs
from salescast.session import discard, materialize

COORDINATES = 64
MATCHES = 36
#: Classes of a large group that one task compares with each other.
BLOCK = 512
#: Blocks of an open group that are all compared with each other; a larger group is compared along its postings.
DENSE = 16
#: Classes of a posting list that are paired one by one; a longer list is compared in blocks.
SHORT = 32
#: Bytes of text that a task turns into shingles at once.
RUN = 2 << 20

UNIT = "unit long, other long, cluster long, node long, block long, signature binary, shingles binary"


def _signed(documents: DataFrame, size: int) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in runs(batch, "text", RUN):
                sets, begin = shingle_sets(rows["text"], size)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": rows["doc_id"], "n_shingles": pa.array(np.diff(begin)),
                    "print": pa.array(fingerprints(sets, begin), pa.binary()),
                    "signature": pa.array([s.tobytes() for s in signatures(sets, begin, COORDINATES)], pa.binary()),
                })

    return documents.mapInArrow(sign, "doc_id bigint, n_shingles bigint, print binary, signature binary")


def _postings(classes: DataFrame) -> DataFrame:
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.frombuffer(b"".join(batch["signature"].to_pylist()), np.int64)
            yield pa.RecordBatch.from_pydict({
                "posting": pa.array(values), "node": pa.array(np.repeat(batch["node"].to_numpy(), COORDINATES))})

    return classes.select("node", "signature").mapInArrow(post, "posting bigint, node bigint")


def _prefixes(classes: DataFrame) -> DataFrame:
    """The rarest postings of each class that may be part of a candidate pair, as (posting, node)."""
    often = _postings(classes).groupBy("posting").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    shared = (_postings(classes).join(often, "posting").groupBy("node")
              .agg(F.sort_array(F.collect_list(F.struct("often", "posting"))).alias("lists")))  # COORDINATES at most
    return (shared.where(F.size("lists") >= MATCHES)
            .select("node", F.explode(F.expr(f"slice(lists, 1, size(lists) - {MATCHES} + 1)")).alias("list"))
            .select("list.posting", "node"))


def _links(left: list[int], right: list[int] | None, signed: np.ndarray, sets: list[np.ndarray],
           percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``left``, or between ``left`` and ``right``."""
    rows = left if right is None else left + right
    if right is not None and not (left and right) or len(rows) < 2:
        return []
    a, b = (slice(None), slice(None)) if right is None else (slice(len(left)), slice(len(left), None))
    values = signed[rows]
    hits = np.zeros((len(values[a]), len(values[b])), np.uint8)
    for k in range(COORDINATES):
        hits += values[a, k][:, None] == values[b, k][None, :]
    good = hits >= MATCHES
    if right is None:
        good &= np.tri(len(rows), k=-1, dtype=bool).T
    if not good.any():
        return []
    # Sizes of intersections by a product of incidence matrices, over the shingles that two classes have.
    size = np.array([len(sets[r]) for r in rows])
    shingle, often = np.unique(np.concatenate([sets[r] for r in rows]), return_counts=True)
    shingle = shingle[often > 1]
    both = np.zeros(good.shape, np.float64)
    for k in range(0, len(shingle), 4096):
        part = shingle[k: k + 4096]
        has = np.zeros((len(rows), len(part)), np.float32)
        for i, r in enumerate(rows):
            own = sets[r][np.searchsorted(sets[r], part[0]): np.searchsorted(sets[r], part[-1], "right")]
            at = np.searchsorted(part, own)
            at = at[part[np.minimum(at, len(part) - 1)] == own]
            has[i, at] = 1
        both += has[a] @ has[b].T
    union = size[a][:, None] + size[b][None, :] - both
    found = np.argwhere(good & (100 * both >= percent * union))
    root = list(range(len(rows)))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    out = []
    for i, j in found.tolist():
        j += 0 if right is None else len(left)
        if top(i) != top(j):
            root[top(i)] = top(j)
            out.append((rows[i], rows[j]))
    return out


def _confirm(percent: int):
    """Links of one work unit: many whole groups, a block of a large one, or a pair of blocks of it."""

    def confirm(unit: pa.Table) -> pa.Table:
        node, cluster, block = (unit[c].to_numpy() for c in ("node", "cluster", "block"))
        signed = np.frombuffer(b"".join(unit["signature"].to_pylist()), np.uint64).reshape(-1, COORDINATES)
        sets = [np.frombuffer(s, np.uint64) for s in unit["shingles"].to_pylist()]
        pair = unit["unit"][0].as_py() != unit["other"][0].as_py()
        order, out = np.lexsort((node, cluster)), []
        for rows in np.split(order, np.flatnonzero(np.diff(cluster[order])) + 1):
            if pair:
                low = block[rows] == block[rows].min()
                out += _links(rows[low].tolist(), rows[~low].tolist(), signed, sets, percent)
            else:
                out += _links(rows.tolist(), None, signed, sets, percent)
        ends = np.array(out, np.int64).reshape(-1, 2)
        return pa.table({"a": pa.array(node[ends[:, 0]]), "b": pa.array(node[ends[:, 1]])})

    return confirm


def _colliding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs (a, b, left, right: signatures) those that collide often enough."""
    for batch in batches:
        left, right = (np.frombuffer(b"".join(batch[c].to_pylist()), np.uint64).reshape(-1, COORDINATES)
                       for c in ("left", "right"))
        good = (left == right).sum(axis=1) >= MATCHES
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def _similar(percent: int):
    """Of pairs (a, b, left, right: sets) those that are linked."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for left, right in zip(batch["left"], batch["right"]):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (left, right))
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return link


def _with_both(pairs: DataFrame, classes: DataFrame, column: str) -> DataFrame:
    """``pairs`` (a, b) with a column of both classes as left and right."""
    one, two = (classes.select(F.col("node").alias(end), F.col(column).alias(side)) for end, side in (("a", "left"), ("b", "right")))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "left", "right")


def _along_postings(rooted: DataFrame, prefixes: DataFrame, classes: DataFrame, percent: int, block: int, short: int) -> DataFrame:
    """Links (a, b) between different components of ``rooted`` (node, root) whose classes share a prefix posting.

    ``classes`` has node, signature and shingles. Of a list longer than ``short`` each block and each pair of its blocks is a
    work unit and gives a spanning forest.
    """
    held = prefixes.join(rooted, "node")
    lists = held.groupBy("posting").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    held = materialize(held.join(lists.where("low <> high").select("posting", "n"), "posting"), "open-postings")

    few = held.where(F.col("n") <= short)
    left, right = (few.select("posting", F.col("node").alias(end), F.col("root").alias(f"{end}_root")) for end in ("a", "b"))
    pairs = left.join(right, "posting").where("a < b and a_root <> b_root").select("a", "b").distinct()
    pairs = materialize(_with_both(pairs, classes, "signature").mapInArrow(_colliding, "a bigint, b bigint"), "collisions")
    linked = materialize(_with_both(pairs, classes, "shingles").mapInArrow(_similar(percent), "a bigint, b bigint"), "links")

    many = held.where(F.col("n") > short).withColumn("parts", F.ceil(F.col("n") / block))
    many = many.withColumn("block", F.pmod(F.xxhash64("node", "posting"), "parts")).withColumn(
        "against", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    units = (many.withColumn("unit", F.xxhash64("posting", F.least("block", "against")))
             .withColumn("other", F.xxhash64("posting", F.greatest("block", "against")))
             .join(classes.select("node", "signature", "shingles"), "node")
             .select("unit", "other", F.col("posting").alias("cluster"), "node", "block", "signature", "shingles"))
    dealt = materialize(units.groupBy("unit", "other").applyInArrow(_confirm(percent), "a bigint, b bigint"), "links")
    discard(held, pairs)
    return linked.unionByName(dealt)


def near_duplicates(documents: DataFrame, percent: int = 85, size: int = 5, block: int = BLOCK, dense: int = DENSE,
                    short: int = SHORT) -> DataFrame:
    """Documents (doc_id, text) with the component that links of at least ``percent`` of a hundred similarity give them.

    ``block``, ``dense`` and ``short`` decide how the work is cut, not what is found.
    Returns doc_id, n_shingles, component_id (the smallest doc_id reachable), kept; a row per row of ``documents``.
    """
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = materialize(_signed(documents, size), "signatures")
    classes = materialize(
        signed.where("n_shingles > 0").groupBy("print")
        .agg(F.min("doc_id").alias("doc_id"), F.first("signature").alias("signature"))
        .withColumn("node", F.monotonically_increasing_id()), "classes")

    prefixes = materialize(_prefixes(classes), "prefixes")
    first = prefixes.groupBy("posting").agg(F.min("node").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = components(prefixes.join(first, "posting").select(F.col("first").alias("a"), F.col("node").alias("b")))
    sizes = groups.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    members = groups.join(sizes, "root").select(
        F.col("root").alias("cluster"), "node", F.ceil(F.col("members") / block).alias("blocks"))
    members = members.select("cluster", "node", "blocks", F.pmod(F.xxhash64("node"), "blocks").alias("block"))
    members = materialize(members.join(classes.select("node", "doc_id", "print", "signature"), "node"), "members")
    discard(groups)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in runs(batch, "text", RUN):
                sets, begin = shingle_sets(rows["text"], size)
                same = [i for i, (p, q) in enumerate(zip(rows["print"].to_pylist(), fingerprints(sets, begin))) if p == q]
                held = [sets[begin[i]: begin[i + 1]].tobytes() for i in same]
                kept = rows.select(["cluster", "node", "blocks", "block", "signature"]).take(pa.array(same, pa.int64()))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(held, pa.binary())],
                                                 [*kept.schema.names, "shingles"])

    kind = "cluster bigint, node bigint, blocks bigint, block bigint, signature binary, shingles binary"
    fetched = (documents.select(F.col("doc_id").alias("id"), "text")
               .join(members, F.col("id").eqNullSafe(F.col("doc_id")))
               .select("text", "print", "cluster", "node", "blocks", "block", "signature").mapInArrow(fetch, kind))
    # Rows with the same id and text give a class twice; one of them is enough.
    fetched = materialize(fetched.dropDuplicates(["node"]), "fetched")
    discard(members)

    many = max(1, fetched.select("node").count() // block)
    unit = F.when(F.col("blocks") == 1, -1 - F.pmod(F.xxhash64("cluster"), F.lit(many))).otherwise(F.xxhash64("cluster", "block"))
    columns = ["unit", "other", "cluster", "node", "block", "signature", "shingles"]
    alone = fetched.withColumn("unit", unit).withColumn("other", F.col("unit")).select(*columns)
    links = materialize(alone.groupBy("unit", "other").applyInArrow(_confirm(percent), "a bigint, b bigint"), "links")

    large = fetched.where("blocks > 1")
    roots = components(links)
    labelled = large.select("cluster", "node", "blocks").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = labelled.groupBy("cluster", "blocks").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    pairs = large.join(open_.where(F.col("blocks") <= dense).select("cluster"), "cluster", "left_semi").withColumn(
        "against", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).where("against <> block")
    pairs = (pairs.withColumn("unit", F.xxhash64("cluster", F.least("block", "against")))
             .withColumn("other", F.xxhash64("cluster", F.greatest("block", "against"))).select(*columns))
    more = materialize(pairs.groupBy("unit", "other").applyInArrow(_confirm(percent), "a bigint, b bigint"), "links")
    found, wide = [links, more], open_.where(F.col("blocks") > dense).select("cluster")
    if not wide.isEmpty():
        rooted = labelled.join(wide, "cluster", "left_semi").select("node", "root")
        found.append(materialize(_along_postings(rooted, prefixes, large, percent, block, short), "links"))
    discard(prefixes, fetched, roots)
    roots = components(functools.reduce(DataFrame.unionByName, found))

    labels = classes.select("node", "doc_id", "print").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = labels.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labels = labels.join(least, "root").select("print", "component_id")
    result = materialize(
        signed.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("print")).alias("print"))
        .join(labels, "print", "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")), "components")
    discard(signed, classes, *found, roots)
    return result.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
