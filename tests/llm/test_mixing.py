import math
import random
import re
from collections import Counter, defaultdict

import pytest
from helpers import SPACED
from pyspark.sql import functions as F

from salescast.llm import mixing as m

SCHEMA = "doc_id bigint, text string, source string, size bigint, row string, target string, shard string, pass int"


def table(spark, rows):
    """(doc_id, text, source), with columns whose names the operator uses itself."""
    return spark.createDataFrame([(i, t, s, len(SPACED.findall(t or "")), "r", "t", "s", 7) for i, t, s in rows], SCHEMA)


def some(n=600, seed=0, sources=("a", "B", "é", None, "zz")):
    rng = random.Random(seed)
    shares = [0.5, 0.02, 0.3, 0.13, 0.05][: len(sources)]
    return [(i, " ".join(["w"] * rng.randrange(0, 60)), rng.choices(sources, shares)[0]) for i in range(n)]


def expected_targets(sizes, weights=(5, 2, 1), most=3):
    """Resharing the excess by weight, turn after turn."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, free = dict.fromkeys(names, 0.0), float(sum(sizes.values())), {s for s in names if sizes[s]}
    while left > 1e-9 and free:
        total = sum(weight[s] for s in free)
        share = {s: target[s] + left * weight[s] / total for s in free}
        left = sum(max(0.0, v - most * sizes[s]) for s, v in share.items())
        for s, v in share.items():
            target[s] = min(v, most * sizes[s])
        free = {s for s in free if target[s] < most * sizes[s]}
    return target


def check(rows, result):
    sizes, target, taken = Counter(), {}, Counter()
    for i, text, source in rows:
        sizes[source] += len(SPACED.findall(text or ""))
    want, longest = expected_targets(sizes), defaultdict(int)
    assert len(result) == len(rows)
    for r in result:
        assert (r.taken == 0 if not r.size else r.taken % r.size == 0) and 0 <= r.taken <= 3 * r.size
        assert r.source_size == sizes[r.source] and math.isclose(r.target, want[r.source], rel_tol=1e-9, abs_tol=1e-9)
        target[r.source] = r.target
        taken[r.source] += r.taken
        longest[r.source] = max(longest[r.source], r.size)
        # Whole passes take every row, the last one some.
        whole = int(r.target / r.source_size + 1e-9) if r.source_size else 0
        assert r.size == 0 or r.taken // r.size in (whole, whole + 1)
    for source in sizes:
        assert abs(taken[source] - target[source]) <= longest[source] / 2 + 1e-6


def test_targets_and_taken_sizes(spark):
    rows = some() + [(1000, None, "a"), (1001, "", "empty"), (1002, "x " * 20_000, "é")]
    got = m.taken_sizes(m.mix(table(spark, rows), block=100, shard=2000))
    assert got.columns == ["doc_id", "text", "source", "size", "shard", "pass", "source_size", "target", "taken"]
    check(rows, got.collect())


@pytest.mark.parametrize("rows", [[], [(1, None, None), (1, "", None)], [(1, "one", "s")], [(i, "two words", "s") for i in range(9)]])
def test_small_tables(spark, rows):
    check(rows, m.taken_sizes(m.mix(table(spark, rows))).collect())


def test_rows_alike_are_told_apart_and_partitioning_changes_nothing(spark):
    rows = some(200, 1) + [(5, "the same words again", "B")] * 300
    data = table(spark, rows)
    results = [m.taken_sizes(m.mix(data.repartition(n), block=50, shard=500)).collect() for n in (1, 7, 7)]
    check(rows, results[0])
    assert len({tuple(sorted(map(repr, r))) for r in results}) == 1


def test_shards_get_exact_disjoint_blocks(spark):
    rows = some(800, 2)
    mixed = m.mix(table(spark, rows), block=64, shard=1000)
    sources = {r.source_number: r for r in mixed.sources.collect()}
    shards = max(r.shard for r in mixed.draws.collect()) + 1
    parts = [(r.shard, p) for r in m.leaves(mixed.sources, shards).collect() for p in r.parts]
    total = sum(s.quota for s in sources.values())
    for number, source in sources.items():
        own = sorted((p.first, p.quota) for _, p in parts if p.source_number == number)
        assert [a for a, _ in own] == [sum(q for _, q in own[:i]) for i in range(len(own))] and sum(q for _, q in own) == source.quota
    blocks = Counter()
    for shard, p in parts:
        blocks[shard] += p.quota
    # Halves of a node have the share of their shards, rounded down and up, level by level.
    assert set(blocks) == set(range(shards)) and all(abs(n - total / shards) <= math.log2(shards) + 1 for n in blocks.values())
    assert mixed.draws.select("row", "pass").distinct().count() == mixed.draws.count()
    # Every drawn row is in the shard that holds its block.
    where = {(p.source_number, p.first + k): shard for shard, p in parts for k in range(p.quota)}
    assert len(where) == total and {r.shard for r in mixed.draws.collect()} <= set(where.values())


def test_written_shards(spark, tmp_path):
    rows = some(300, 3)
    mixed = m.mix(table(spark, rows), block=64, shard=1000)
    m.write_mix(mixed, str(tmp_path / "mix"))
    written = spark.read.parquet(str(tmp_path / "mix"))
    assert {"doc_id", "text", "source", "shard"} <= set(written.columns) and written.count() == mixed.draws.count()
    taken = m.taken_sizes(mixed).agg(F.sum("taken")).first()[0]
    assert written.agg(F.sum("size")).first()[0] == taken


def test_draws_follow_the_distribution(spark):
    cases = [(0, 0, 0), (5, 0, 3), (0, 5, 3), (3, 4, 5), (20, 30, 17), (200, 100, 150), (3000, 5000, 2500), (1, 10 ** 6, 10 ** 5), (7, 7, 14)]
    rows = [(g, b, n, (k + 0.5) / 40) for g, b, n in cases for k in range(40)]
    data = spark.createDataFrame(rows, "good bigint, bad bigint, n bigint, u double")
    for r in data.select("*", m.hypergeometric(*map(F.col, ("u", "good", "bad", "n"))).alias("x")).collect():
        total, up, x = math.comb(r.good + r.bad, r.n), 0, max(0, r.n - r.bad)
        while x < min(r.good, r.n) and (up := up + math.comb(r.good, x) * math.comb(r.bad, r.n - x)) / total < r.u:
            x += 1
        assert r.x == x


def test_large_draws_lie_where_they_should(spark):
    good, bad, n = 1_000_000, 1_500_000, 1_250_000
    data = spark.range(200).select(m.hypergeometric(m._uniform("id"), F.lit(good), F.lit(bad), F.lit(n)).alias("x"))
    got = [r.x for r in data.collect()]
    mean, deviation = n * good / (good + bad), math.sqrt(n * 0.4 * 0.6 * 0.5)
    assert abs(sum(got) / len(got) - mean) < 4 * deviation / math.sqrt(200)
    assert 0.8 < math.sqrt(sum((x - mean) ** 2 for x in got) / 200) / deviation < 1.2


def test_words(spark):
    texts = ["", None, " a\tb\nc\x0bd\x0ce\rf ", "é x y", "   "]
    data = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in data.select(m.words(F.col("text"))).collect()] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]
