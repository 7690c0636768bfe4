import random

import helpers
import pytest

from salescast.llm.components import components
from salescast.llm.near_dedup import near_duplicates


def shingles(text, size=5):
    words = helpers.spaced(text)
    return {tuple(words[k: k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)} - {()}


def brute(docs, percent=85):
    sets = [shingles(t) for _, t in docs]
    root = list(range(len(docs)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    out = []
    for i, (doc_id, _) in enumerate(docs):
        own = least.get(top(i)) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), own, doc_id is not None and doc_id == own))
    return sorted(out, key=repr)


def made(seed):
    """Groups of copies with a few changed words, chains of them, short texts, and passages that many share."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    passage, docs, n = [word() for _ in range(30)], [], 100
    for group in (60, 5, 2, 1):
        base = [word() for _ in range(150)]
        for _ in range(group):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            base = copy if rng.random() < 0.3 else base
            docs.append((n := n + 1, " ".join(copy)))
    docs += [((n := n + 1), " ".join(passage + [word() for _ in range(20)])) for _ in range(15)]
    docs += [(1, "a b"), (2, "A  b"), (3, "a b c"), (4, ""), (5, None), (6, " \n"), (7, "a b"), (7, "a b"), (None, docs[0][1]), (None, "z z"),
             (8, docs[0][1]), (8, "other words")]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("block", [512, 8])
def test_equals_brute_force(spark, block):
    docs = made(block)
    got = near_duplicates(helpers.documents(spark, docs).repartition(4), block=block)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs)


@pytest.mark.parametrize("short", [3, 200])
def test_large_groups_along_postings_equal_brute_force(spark, short):
    docs = made(5)
    got = near_duplicates(helpers.documents(spark, docs).repartition(4), block=4, dense=2, short=short)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs)


def test_chain_of_classes_that_share_values_in_pairs(spark, monkeypatch):
    """Two thirds of each text are in the next one: one group of many blocks, in which few are linked."""
    rng = random.Random(9)
    words = [f"w{rng.randrange(1 << 30)}" for _ in range(14_500)]
    docs = [(i, words[24 * i: 24 * i + 80]) for i in range(600)]
    docs += [(1000 + i, [*t[:-1], "changed"]) for i, t in docs if i % 7 == 0]
    docs = [(i, " ".join(t)) for i, t in docs]
    from salescast.llm import near_dedup

    blocks = []
    plain = near_dedup._along_postings
    monkeypatch.setattr(near_dedup, "_along_postings",
                        lambda rooted, *rest: blocks.append(rooted.count()) or plain(rooted, *rest))
    got = near_duplicates(helpers.documents(spark, docs).repartition(4), block=8)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(
        ((i, 76, i % 1000, i < 1000) for i, _ in docs), key=repr)
    assert blocks and blocks[0] > 8 * near_dedup.DENSE


def test_empty_table(spark):
    assert near_duplicates(helpers.documents(spark, [])).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100 + i, 100) for i in range(20)] + [(200, 201), (201, 200), (300, 300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert len({got[i] for i in range(31)}) == 1 and len({got[100 + i] for i in range(20)}) == 1
    assert got[200] == got[201] and 300 not in got and len(set(got.values())) == 3
