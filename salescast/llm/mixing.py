"""A mix of sources at target weights, with DataFrame functions only.

Every source is cut into blocks by the first bits of its rows' hashes: a hash order is a random order, and another one for every
pass over the source. A target of 2.4 times the source takes two whole passes and the first blocks of the third, the last of
which is cut at the row where the words come nearest to the target. That gives each source an exact quota of blocks.

Quotas are dealt to the output shards by a splitting tree. A node has a range of shards and, for each source, how many blocks it
has and where these begin; its left half gets a multivariate hypergeometric draw of them, one source after the other, each a
hypergeometric draw given those before; the right half gets the rest. So every shard's blocks are distributed as if all blocks had been
shuffled, counts add up exactly, and nothing but the tree is made for it. A leaf's blocks are a range of its sources' blocks,
disjoint from all others, taken in a permuted order (multiplied by a prime and shifted, modulo the quota). Rows find their shards
by block; within a shard they are ordered by a hash.

Rows that are alike in everything are numbered (by input partition, so that no task holds all of them) and the number enters the
hash; which of them gets which number changes nothing. So the mix is the same for every run and every partitioning.

Edge cases: a null text or size is 0 and taken like others, which adds no words. Sources are in order of code points, null last; a
source without words has the target 0 and takes part with none. An empty table has no mix. A table of one source is taken once.
Very long texts are not cut: the last row taken is the one that brings the source nearest to its target. Names of columns are chosen
so that they don't clash with those of the input; columns called like added ones are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescast.llm.text import unused
from salescast.session import materialize

WEIGHTS = (5.0, 2.0, 1.0)
#: Passes over a source at most.
MOST = 3
#: Words of a block and of a shard, about.
BLOCK, SHARD = 1 << 16, 1 << 22
#: Bits of a hash, bits that one round of the search for the last row reads, and bits of a block's number at most.
BITS, STEP, DEEPEST = 60, 10, 30
#: Primes beyond any quota, for the permutation; products stay within 63 bits.
PRIMES = (2_147_483_647, 2_147_483_629)
SEED = 11


@dataclass(frozen=True)
class Mix:
    """The mix of a table.

    ``rows``: the input with row, source_size and target. ``draws``: row, pass, shard and rank, one for each time that a row is
    taken. ``sources``: source, source_number, source_size, target, passes (whole ones), bits (of a block's number), cut (last hash of
    the pass that is not whole) and quota (blocks).
    """

    rows: DataFrame
    draws: DataFrame
    sources: DataFrame


def words(text: Column) -> Column:
    """Number of words, runs of characters other than the six ASCII spaces; null has none."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _uniform(*parts: Column | str | int) -> Column:
    """A number in (0, 1) from a hash of the parts."""
    parts = [F.lit(p) if isinstance(p, int) else p for p in parts]
    return (F.call_function("shiftrightunsigned", F.xxhash64(F.lit(SEED), *parts), F.lit(11)) + 0.5) / F.lit(float(1 << 53))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _log_factorial(n: Column) -> Column:
    """ln n! by a table up to 15 and Stirling's series, exact to rounding, beyond."""
    table = F.array(*(F.lit(math.lgamma(k + 1)) for k in range(16)))

    def series(x: Column) -> Column:
        return (x + 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x) + 1 / (1260 * F.pow(x, F.lit(5)))

    return _let(n, lambda k: F.when(k < 16, F.get(table, k.cast("int"))).otherwise(series(F.greatest(k, F.lit(1)).cast("double"))))


def hypergeometric(u: Column, good: Column, bad: Column, n: Column) -> Column:
    """How many of ``n`` things drawn from ``good`` and ``bad`` ones are good: the value where the distribution reaches ``u``.

    Probabilities are added up from twelve standard deviations below the mean, before which less than a rounding lies.
    """
    choose = lambda a, b: _log_factorial(a) - _log_factorial(b) - _log_factorial(a - b)

    def bounds(s: Column) -> Column:
        total = s["good"] + s["bad"]
        mean = F.coalesce(F.try_divide(s["n"].cast("double") * s["good"], total), F.lit(0.0))
        spread = F.sqrt(F.coalesce(mean * F.try_divide(s["bad"], total) * (total - s["n"]) / F.greatest(total - 1, F.lit(1)), F.lit(0.0)))
        low = F.greatest(F.lit(0).cast("long"), s["n"] - s["bad"], F.floor(mean - 12 * spread - 4))
        high = F.least(s["n"], s["good"], F.ceil(mean + 12 * spread + 4))
        return F.struct(*(s[c].alias(c) for c in ("good", "bad", "n", "u")), low.alias("low"), high.alias("high"))

    def walk(s: Column) -> Column:
        p = F.exp(choose(s["good"], s["low"]) + choose(s["bad"], s["n"] - s["low"]) - choose(s["good"] + s["bad"], s["n"]))
        # The probability of k, that of all up to k, and how many values lie below u.
        start = _let(p, lambda first: F.struct(first.alias("p"), first.alias("up"), F.lit(0).cast("long").alias("below")))

        def step(state: Column, k: Column) -> Column:
            ratio = (s["good"] - k).cast("double") * (s["n"] - k) / ((k + 1).cast("double") * (s["bad"] - s["n"] + k + 1))
            return _let(state["p"] * ratio, lambda after: F.struct(
                after.alias("p"), (state["up"] + after).alias("up"), (state["below"] + (state["up"] < s["u"]).cast("long")).alias("below")))

        steps = F.when(s["high"] > s["low"], F.sequence(s["low"], s["high"] - 1)).otherwise(F.array().cast("array<bigint>"))
        return s["low"] + F.aggregate(steps, start, step)["below"]

    things = F.struct(good.cast("long").alias("good"), bad.cast("long").alias("bad"), n.cast("long").alias("n"), u.alias("u"))
    return _let(things, lambda s: _let(bounds(s), walk))


# Sources --------------------------------------------------------------------------------------------------


def _numbered(sources: DataFrame) -> DataFrame:
    """``source_number`` from 0 by code points, null last: the place in its sort task, and the sizes of the earlier ones."""
    placed = materialize(sources.orderBy(F.col("source").asc_nulls_last()).withColumn("place", F.monotonically_increasing_id()), "sources")
    placed = placed.withColumn("part", F.shiftright("place", 33))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row per sort task
    return (placed.join(sizes.withColumn("before", before).drop("n"), "part")
            .withColumn("source_number", F.col("before") + F.col("place") - F.col("first")).drop("part", "place", "first", "before"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``sizes`` (source, source_size) with ``source_number``, ``target`` and ``passes``.

    Weights repeat over the sources in order and share all words. A target beyond ``most`` times its source stops there; what is
    left is shared by those that don't, until none is above. Every turn is one aggregate that gives two numbers.
    """
    weight = F.get(F.array(*(F.lit(float(w)) for w in weights)), (F.col("source_number") % len(weights)).cast("int"))
    known = materialize(_numbered(sizes).withColumn("weight", weight).withColumn("limit", most * F.col("source_size")), "weights")
    level = 0.0
    while True:
        free = F.col("limit") > F.col("weight") * level  # sources that this level does not fill
        row = known.agg(F.sum("source_size").alias("all"), F.sum(F.when(~free, F.col("limit"))).alias("full"),
                        F.sum(F.when(free, F.col("weight"))).alias("weights")).first()
        if not row["all"] or not row["weights"]:
            break
        after = (row["all"] - (row["full"] or 0)) / row["weights"]
        if after <= level:
            break
        level = after
    target = F.least(F.col("weight") * level, F.col("limit").cast("double"))
    passes = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size"))).otherwise(0).cast("int")
    return known.withColumn("target", target).withColumn("passes", F.least(passes, F.lit(most))).drop("weight", "limit")


def _hash(number: Column) -> Column:
    """The hash of a row in a pass over its source, of ``BITS`` bits."""
    return F.call_function("shiftrightunsigned", F.xxhash64(F.lit(SEED), number, "alike", "copy", "source_number"), F.lit(64 - BITS))


def _shift(value: Column, by: Column) -> Column:
    return F.call_function("shiftright", value, by.cast("int"))


def cuts(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """(source_number, cut): the last hash taken in the pass that is not whole, for each source that has one.

    Words are summed by the first bits of the hashes, then by further bits within the range where the target is reached, until
    that is a single row. A table of ranges has at most 2 ** ``STEP`` rows for each source.
    """
    left = F.col("target") - F.col("passes") * F.col("source_size")
    wanted = sources.select(F.col("source_number").alias("of"), "passes", left.alias("left")).where("left > 0")
    rows = rows.join(wanted, F.col("source_number") == F.col("of")).select("source_number", "size", "left", _hash(F.col("passes")).alias("hash"))
    out, depth, open_ = None, 0, True
    while open_:
        depth += STEP
        low = F.lit(BITS - depth)
        ranges = rows.groupBy("source_number", _shift(F.col("hash"), low).alias("range")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"), F.max("hash").alias("last"), F.max("left").alias("left"))
        before = F.sum("words").over(Window.partitionBy("source_number").orderBy("range")) - F.col("words")
        reached = F.min(F.when(F.col("before") + F.col("words") >= F.col("left"), F.struct("range", "n", "last", "words", "before", "left")))
        found = ranges.withColumn("before", before).groupBy("source_number").agg(reached.alias("r"))
        found = materialize(found.select("source_number", "r.*"), "reached")
        begin = F.call_function("shiftleft", F.col("range"), low)
        nearer = F.col("before") + F.col("words") - F.col("left") <= F.col("left") - F.col("before")
        # Where rounding leaves the target unreached, all rows are taken.
        cut = F.when(F.col("range").isNull(), F.lit((1 << BITS) - 1)).when(nearer, F.col("last")).otherwise(begin - 1)
        single = F.col("range").isNull() | (F.col("n") == 1) | F.lit(depth == BITS)
        done = found.where(single).select("source_number", cut.alias("cut"))
        out = done if out is None else out.unionByName(done)
        inside = found.where(~single).select(F.col("source_number").alias("of"), "range", "before")
        open_ = not inside.isEmpty()
        if open_:
            same = (F.col("source_number") == F.col("of")) & (_shift(F.col("hash"), low) == F.col("range"))
            rows = materialize(rows.join(inside, same).select(
                "source_number", "size", (F.col("left") - F.col("before")).alias("left"), "hash"), "inside")
    return out


def quotas(sources: DataFrame, cut: DataFrame, block: int = BLOCK) -> DataFrame:
    """``sources`` with ``bits`` of a block's number, ``cut`` and ``quota``, the number of blocks that the mix takes."""
    bits = F.greatest(F.lit(0), F.least(F.lit(DEEPEST), F.ceil(F.log2(F.greatest(F.col("source_size") / block, F.lit(1.0)))))).cast("int")
    cut = cut.select(F.col("source_number").alias("of"), "cut")
    known = sources.join(cut, F.col("source_number") == F.col("of"), "left").drop("of").withColumn("bits", bits)
    partial = F.coalesce(_shift(F.col("cut"), BITS - F.col("bits")) + 1, F.lit(0))  # a cut of -1 takes none
    whole = F.col("passes") * F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bits"))
    return known.withColumn("quota", whole + partial)


# Shards ---------------------------------------------------------------------------------------------------

PART = "struct<source_number: bigint, first: bigint, quota: bigint>"


def split(nodes: DataFrame) -> DataFrame:
    """Both halves of each node (shard, shards, parts); leaves stay."""
    parts = F.col("parts")
    total = F.aggregate(parts, F.lit(0).cast("long"), lambda a, p: a + p["quota"])
    nodes = nodes.withColumn("all", total).withColumn("half", F.expr("shards div 2"))

    def draw(state: Column, part: Column) -> Column:
        u = _uniform(F.col("shard"), F.col("shards"), part["source_number"])
        taken = hypergeometric(u, part["quota"], state["rest"] - part["quota"], state["need"])
        return _let(taken, lambda x: F.struct(
            (state["need"] - x).alias("need"), (state["rest"] - part["quota"]).alias("rest"), F.array_append(state["taken"], x).alias("taken")))

    start = F.struct(F.expr("all * half div shards").alias("need"), F.col("all").alias("rest"), F.array().cast("array<bigint>").alias("taken"))
    nodes = nodes.withColumn("taken", F.aggregate(parts, start, draw)["taken"])

    def half(begin: Callable, count: Callable) -> Column:
        made = F.zip_with("parts", "taken", lambda p, x: F.struct(
            p["source_number"].alias("source_number"), begin(p, x).alias("first"), count(p, x).alias("quota")))
        return F.filter(made, lambda p: p["quota"] > 0)

    node = lambda shard, shards, own: F.struct(shard.alias("shard"), shards.alias("shards"), own.alias("parts"))
    left = node(F.col("shard"), F.col("half"), half(lambda p, x: p["first"], lambda p, x: x))
    right = node(F.col("shard") + F.col("half"), F.col("shards") - F.col("half"),
                 half(lambda p, x: p["first"] + x, lambda p, x: p["quota"] - x))
    children = F.when(F.col("shards") > 1, F.array(left, right)).otherwise(F.array(node(F.col("shard"), F.col("shards"), parts)))
    return nodes.select(F.explode(children).alias("node")).select("node.*")


def leaves(sources: DataFrame, shards: int) -> DataFrame:
    """(shard, parts): for each shard its sources, where its blocks begin among the source's, and how many they are."""
    part = F.struct("source_number", F.lit(0).cast("long").alias("first"), "quota")
    nodes = sources.where("quota > 0").agg(F.sort_array(F.collect_list(part)).alias("parts"))  # the root: an entry for each source
    nodes = nodes.select(F.lit(0).cast("long").alias("shard"), F.lit(shards).cast("long").alias("shards"), F.col("parts").cast(f"array<{PART}>"))
    nodes = materialize(nodes, "root")
    for _ in range(max(0, math.ceil(math.log2(shards)))):
        nodes = materialize(split(nodes.repartition("shard")), "nodes")
    return nodes.select("shard", "parts")


def _permuted(number: Column) -> Column:
    """The place of a source's block in its permuted order."""
    prime = F.when(F.col("quota") % PRIMES[0] == 0, F.lit(PRIMES[1])).otherwise(F.lit(PRIMES[0])).cast("long")
    shift = F.pmod(F.xxhash64(F.lit(SEED), F.col("source_number")), F.col("quota"))
    return F.pmod(F.pmod(number * prime, F.col("quota")) + shift, F.col("quota"))


def _numbered_copies(rows: DataFrame) -> DataFrame:
    """``rows`` (row, alike, ...) with ``copy``, which numbers those that are alike."""
    rows = rows.withColumn("part", F.shiftright("row", 33))
    own = F.row_number().over(Window.partitionBy("alike", "part").orderBy("row")) - 1
    earlier = Window.partitionBy("alike").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = rows.groupBy("alike", "part").agg(F.count(F.lit(1)).alias("n")).withColumn("before", F.sum("n").over(earlier))
    pieces = pieces.where("before is not null").select(F.col("alike").alias("as"), F.col("part").alias("in"), "before")
    joined = rows.withColumn("own", own).join(pieces, (F.col("alike") == F.col("as")) & (F.col("part") == F.col("in")), "left")
    return joined.withColumn("copy", F.col("own") + F.coalesce("before", F.lit(0))).drop("own", "before", "as", "in", "part")


def mix(rows: DataFrame, source: str = "source", size: str = "size", weights: tuple[float, ...] = WEIGHTS, most: int = MOST,
        block: int = BLOCK, shard: int = SHARD) -> Mix:
    """Mix ``rows`` by ``source``; blocks have ``size`` of about ``block`` and shards of about ``shard``. ``rows`` are written once."""
    rows = rows.drop(*(c for c in rows.columns if c.lower() in ("row", "source_size", "target")))
    given = [F.col(c) for c in sorted(rows.columns)]
    alike = F.xxhash64(*given, *(c.isNull() for c in given))
    key = unused(rows, "alike")
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()).withColumn(key, alike), "rows")
    narrow = rows.select("row", F.col(source).cast("string").alias("source"), F.col(key).alias("alike"),
                         F.coalesce(F.col(size).cast("long"), F.lit(0).cast("long")).alias("size"))
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    known = materialize(targets(sizes, weights, most), "targets")
    of = known.select(F.col("source").alias("of"), "source_number")
    numbered = materialize(_numbered_copies(narrow).join(of, F.col("source").eqNullSafe(F.col("of"))).select(
        "row", "source_number", "size", "alike", "copy"), "copies")
    known = materialize(quotas(known, cuts(numbered, known), block), "quotas")
    total = known.agg(F.sum("target").alias("size"), F.sum("quota").alias("blocks")).first()
    shards = max(1, min(math.ceil((total["size"] or 0) / shard), total["blocks"] or 0))
    blocks = leaves(known, shards).select("shard", F.explode("parts").alias("part")).select(
        "shard", F.col("part.source_number").alias("of"), F.explode(F.sequence(
            F.col("part.first"), F.col("part.first") + F.col("part.quota") - 1)).alias("at"))

    plan = known.select(F.col("source_number").alias("in"), "passes", "bits", "cut", "quota").where("quota > 0")
    taken = numbered.join(plan, F.col("source_number") == F.col("in")).withColumn(
        "pass", F.explode(F.sequence(F.lit(0), F.col("passes")))).withColumn("hash", _hash(F.col("pass")))
    taken = taken.where((F.col("pass") < F.col("passes")) | F.coalesce(F.col("hash") <= F.col("cut"), F.lit(False)))
    number = F.call_function("shiftleft", F.col("pass").cast("long"), F.col("bits")) + _shift(F.col("hash"), BITS - F.col("bits"))
    taken = taken.select("row", "pass", "source_number", "hash", _permuted(number).alias("place"))
    draws = taken.join(blocks, (F.col("source_number") == F.col("of")) & (F.col("place") == F.col("at"))).select(
        "row", "pass", "shard", F.xxhash64(F.lit(SEED), "shard", "hash").alias("rank"))
    shares = known.select(F.col("source").alias("of"), "source_size", "target")
    rows = rows.drop(key).join(shares, F.col(source).cast("string").eqNullSafe(F.col("of"))).drop("of")
    return Mix(rows, materialize(draws, "draws"), known)


def write_mix(mixed: Mix, path: str) -> None:
    """Write the mix as Parquet below ``path``, a folder ``shard=...`` for each shard, its rows shuffled by their ranks."""
    rows = mixed.rows.drop("pass", "shard", "rank")  # names of the draws
    found = rows.join(mixed.draws, "row").repartition("shard").sortWithinPartitions("shard", "rank")
    found.drop("row", "rank", "source_size", "target").write.partitionBy("shard").parquet(path)


def taken_sizes(mixed: Mix, size: str = "size") -> DataFrame:
    """The rows of the input with ``taken``, the size that the mix takes of each, repeats counted."""
    times = mixed.draws.groupBy(F.col("row").alias("of")).agg(F.count(F.lit(1)).alias("times"))
    rows = mixed.rows.join(times, F.col("row") == F.col("of"), "left")
    return rows.withColumn("taken", F.coalesce(F.col(size) * F.col("times"), F.lit(0).cast("long"))).drop("of", "times", "row")
