import hashlib
import random

import helpers
import pytest

from salescast.llm.decontamination import contamination, phrase_table, positional_index, search


def brute(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        words, hit, found = helpers.letters(text), set(), set()
        for item, phrase in items:
            own = helpers.letters(phrase)
            for k in range(max(1, len(own) - window + 1) if own else 0):
                w = own[k: k + window]
                for at in range(len(words) - len(w) + 1):
                    if words[at: at + len(w)] == w:
                        hit.update(range(at, at + len(w)))
                        if item is not None:
                            found.add(str(item))
        out.append((doc_id, len(words), len(hit), sorted(found), bool(hit)))
    return sorted(out, key=repr)


def test_equals_brute_force(spark):
    rng = random.Random(3)
    word = lambda: rng.choice("the of Und a b c d e".split())
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((14, 10, 3, 1, 0, 12, 25, 9))]
    items += [(20, None), (None, "rare phrase here"), (7, "another text of seven"), (21, items[0][1])]
    docs = [(i, " ".join(word() for _ in range(rng.randint(0, 80)))) for i in range(40)]
    docs += [(50, "x " + items[0][1].upper() + "! y"), (51, "a rare, phrase: here"), (52, None), (53, ""), (None, items[5][1]),
             (54, items[6][1] + " " + items[6][1]), (54, items[6][1] + " " + items[6][1]), (54, "other")]
    got = contamination(helpers.documents(spark, docs).repartition(3),
                        spark.createDataFrame(items, "item_id int, text string"), block=200, group=200)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"], r.contaminated) for r in got.collect()), key=repr) == brute(docs, items)
    assert all(r.n_items == len(r["items"]) for r in got.collect())


def test_empty_tables(spark):
    none, item = helpers.documents(spark, []), spark.createDataFrame([(1, "a b")], "item_id int, text string")
    assert contamination(none, item).count() == 0
    got = helpers.rows(contamination(helpers.documents(spark, [(1, "a b c")]), item.limit(0)))
    assert got == [{"doc_id": 1, "n_words": 3, "n_hit": 0, "n_items": 0, "items": [], "contaminated": False}]


def test_exact_and_near_phrases(spark):
    index = positional_index(helpers.documents(spark, [(1, "one two x three. Two one"), (2, "two three"), (3, "one"), (4, "a a a")]))
    exact = search(index, phrase_table(spark, ["one two", "two three", "", "a a"])).collect()
    assert sorted((r.phrase_key, r.doc_id, r.start) for r in exact) == [(0, 1, 0), (1, 2, 0), (3, 4, 0), (3, 4, 1)]
    near = search(index, phrase_table(spark, ["one three", "two one"]), slop=2).collect()
    assert sorted((r.phrase_key, r.doc_id) for r in near) == [(0, 1), (1, 1), (1, 1)]
    assert not [r for r in search(index, phrase_table(spark, ["one three"]), slop=1).collect() if r.start == 0]


def test_common_phrases_in_many_blocks_and_parts(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(12)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(60))) for i in range(300)]
    index = positional_index(helpers.documents(spark, docs).repartition(4), block=400)
    phrases = [f"{a} {b}" for a in words for b in words] + ["w1", "w2 w3 w4", "w1 absent"]
    want = sorted((i, d, at) for i, p in enumerate(phrases) for d, text in docs
                  for at in range(60) if text.split()[at: at + len(p.split())] == p.split())
    for group in (64, 1 << 20):
        found = search(index, phrase_table(spark, phrases), group=group).collect()
        assert sorted((r.phrase_key, r.doc_id, r.start) for r in found) == want
    near = {(r.phrase_key, r.doc_id, r.start) for r in search(index, phrase_table(spark, ["w1 w2 w3"]), slop=4, group=64).collect()}
    assert all({"w1", "w2", "w3"} <= set(docs[d][1].split()[max(0, at - 4): at + 5]) for _, d, at in near) and near


def test_a_long_document_in_the_index(spark):
    rng = random.Random(6)
    words = [rng.choice("abcdefgh") for _ in range(200_000)]
    words[150_000: 150_003] = ["x", "y", "x"]
    index = positional_index(helpers.documents(spark, [(1, " ".join(words)), (2, ""), (3, "x y")]))
    found = search(index, phrase_table(spark, ["x y", "y x"])).collect()
    assert sorted((r.phrase_key, r.doc_id, r.start) for r in found) == [(0, 1, 150_000), (0, 3, 0), (1, 1, 150_001)]


def test_digest_of_items():
    # The query's digest of no items is that of the empty string.
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")


@pytest.mark.parametrize("text", ["a b c d e f g h i j k", "A B C D E F G H I J"])
def test_window_of_ten(spark, text):
    item = spark.createDataFrame([("q", "a b c d e f g h i j")], "item_id string, text string")
    row = contamination(helpers.documents(spark, [(1, text)]), item).first()
    assert (row.n_hit, row["items"]) == (10, ["q"])
