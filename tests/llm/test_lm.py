import math
import random
import zlib
from collections import Counter

import helpers
import numpy as np
import pytest
from pyspark.sql import functions as F

from salescast.llm import lattice
from salescast.llm.lattice import Lattice
from salescast.llm.lm import lattice_scores
from salescast.llm.queries import byte_ranks

RANKS = {bytes([i]): i for i in range(256)} | {p: 256 + i for i, p in enumerate([b" a", b"ab", b"abc", " é".encode(), b"bc", b" ab"])}


def model():
    pieces = sorted(RANKS, key=RANKS.get)
    logs = np.log(np.arange(len(pieces), 0, -1) / sum(range(len(pieces) + 1)))
    return Lattice(pieces, logs), dict(zip(pieces, np.exp(logs)))


def total(word, chance):
    at = [1.0] + [0.0] * len(word)
    for j in range(1, len(word) + 1):
        at[j] = sum(at[i] * chance[word[i:j]] for i in range(j) if word[i:j] in chance)
    return at[-1]


def test_lattice_sums_all_segmentations(monkeypatch):
    found, chance = model()
    rng = random.Random(4)
    words = [b" " + "".join(rng.choice("abcé") for _ in range(rng.randint(1, 9))).encode() for _ in range(60)] + [b""]
    got = found.log_probability(words)
    assert np.allclose(got, [math.log(total(w, chance)) for w in words])
    mass = found.expected(words, np.ones(len(words)))
    assert math.isclose(sum(m * len(p) for m, p in zip(mass, found.pieces)), sum(map(len, words)))
    monkeypatch.setattr(lattice, "WIDE", 3)  # the way of long words
    assert np.allclose(found.log_probability(words), got)
    assert np.allclose(found.expected(words, np.ones(len(words))), mass)


def held(doc_id, n=7, left=2):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % n == left


@pytest.mark.parametrize("block", [1 << 20, 64])
def test_base_scores_equal_brute_force(spark, block):
    rng = random.Random(5)
    docs = [(i, " ".join(rng.choice(["Ab", "abc", "é", "a", "b\tb", str(i)]) for _ in range(rng.randint(0, 30)))) for i in range(60)]
    docs += [(100, None), (101, ""), (None, "a a"), (102, "x" * 5000), (102, "x" * 5000)]
    counts = Counter(t for i, text in docs if not held(i) for t in [*helpers.spaced(text), None])
    n, v = sum(counts.values()), len(counts)
    want = sorted(((i, held(i), len(own := [*helpers.spaced(text), None]), sum(counts[t] > 0 for t in own), n,
                    round(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in own), 6)) for i, text in docs), key=repr)
    got = lattice_scores(helpers.documents(spark, docs).repartition(3), RANKS,
                         F.crc32(F.col("doc_id").cast("string")) % 7 == 2, block=block).collect()
    assert sorted(((*r[:5], round(r.base_score, 6)) for r in got), key=repr) == want
    scores = {}
    for r in got:
        assert r.score < 0
        scores.setdefault(r.doc_id, set()).add(round(r.score, 9))
    assert len(scores[100] | scores[101]) == 1 and len(scores[102]) == 1


def test_nothing_to_learn_from(spark):
    assert lattice_scores(helpers.documents(spark, []), RANKS, F.lit(False)).count() == 0
    row = lattice_scores(helpers.documents(spark, [(1, "a b")]), RANKS, F.lit(True)).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)


def test_long_pieces_of_the_whole_vocabulary(spark):
    pytest.importorskip("public_tokenizers")
    ranks = byte_ranks()
    long = [p for p in ranks if len(p) > 16]
    assert len(long) == 91 and max(map(len, long)) == 33
    words = [p.decode().strip() for p in long if not p.decode(errors="replace").count("\ufffd")]
    words = [w for w in words if w and not any(c.isspace() for c in w)]
    words += ["responsibilities", "правительства", "пользователей", "ありがとうございます", "プログラミング"]
    pieces = sorted(ranks, key=ranks.get)
    logs = -np.log(np.arange(len(pieces)) + 256.0)
    logs -= np.log(np.exp(logs).sum())
    chance = dict(zip(pieces, np.exp(logs)))
    want = {w: math.log10(total(b" " + w.encode(), chance)) for w in words}
    # Without training rounds the scores are those of the ranks.
    got = lattice_scores(helpers.documents(spark, list(enumerate(words))), ranks, F.lit(True), rounds=0).collect()
    end = {round(r.score - want[words[r.doc_id]], 6) for r in got}
    assert len(got) == len(words) and end == {0.0}


def segmentations(word, pieces):
    if not word:
        yield ()
    for k in range(1, len(word) + 1):
        if word[:k] in pieces:
            for rest in segmentations(word[k:], pieces):
                yield (word[:k], *rest)


def test_scores_after_one_round_equal_enumeration(spark):
    rng = random.Random(6)
    docs = [(i, " ".join(rng.choice(["ab", "abc", "é", "a", "bcab"]) for _ in range(rng.randint(0, 12)))) for i in range(50)] + [(99, None)]
    pieces = sorted(RANKS, key=RANKS.get)
    first = 1 / (np.arange(len(pieces)) + 256.0)
    chance = dict(zip(pieces, first / first.sum()))
    counts = Counter(b" " + w.encode() for i, text in docs if not held(i) for w in helpers.spaced(text))
    ends = sum(not held(i) for i, _ in docs)
    mass = dict.fromkeys(pieces, 1.0)
    for word, n in counts.items():
        ways = [(math.prod(chance[p] for p in way), way) for way in segmentations(word, chance)]
        for p, way in ways:
            for piece in way:
                mass[piece] += n * p / sum(q for q, _ in ways)
    whole = sum(mass.values()) + ends + 1
    chance = {p: m / whole for p, m in mass.items()}
    want = {i: sum(math.log10(sum(math.prod(chance[p] for p in way) for way in segmentations(b" " + w.encode(), chance)))
                   for w in helpers.spaced(text)) + math.log10((ends + 1) / whole) for i, text in docs}
    got = lattice_scores(helpers.documents(spark, docs).repartition(3), RANKS, F.crc32(F.col("doc_id").cast("string")) % 7 == 2, block=200)
    assert {r.doc_id: r.score for r in got.collect()} == pytest.approx(want, rel=1e-9)
