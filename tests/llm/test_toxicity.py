import itertools
import random

import helpers
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from salescast.llm.string_kernel import DECAY, LENGTH, WIDEST, Landmarks, windows
from salescast.llm.toxicity import Model, fragments, toxicity


def kernel(s, t):
    def weights(x):
        out = {}
        for places in itertools.combinations(range(len(x)), LENGTH):
            key = tuple(x[i] for i in places)
            out[key] = out.get(key, 0) + DECAY ** (places[-1] - places[0] + 1)
        return out

    a, b = weights(s), weights(t)
    return sum(w * b.get(key, 0) for key, w in a.items())


def test_kernel_equals_its_definition():
    rng = random.Random(3)
    marks = Landmarks([" idiot", "scum", "vequ", "worthless"])
    strings = ["".join(rng.choice("idotscumveqwrhlé. ") for _ in range(rng.randint(0, 10))) for _ in range(150)] + ["", " idxiot"]
    for s, row in zip(strings, marks.compare(strings)):
        for t, value in zip(marks.strings, row):
            want = kernel(s, t)
            assert abs((want / (kernel(s, s) * kernel(t, t)) ** 0.5 if want else 0) - value) < 1e-5


def test_windows_cover_long_fragments():
    text = "".join(chr(97 + i % 26) for i in range(100))
    parts = windows(text)
    assert all(len(p) <= WIDEST for p in parts) and all(any(text[i: i + 12] in p for p in parts) for i in range(88))
    assert windows("") == [""]


def test_fragments_join_split_words():
    found, kind, row = fragments(pa.array(["i.d.i.o.t you", "I d i o t", None, "", "a b-c d"]))
    by_row = [{found[k] for k, r in zip(kind, row) if r == i} for i in range(5)]
    assert {" idiot", " you"} <= by_row[0] and " idiot" in by_row[1] and not by_row[2] and not by_row[3] and " abcd" in by_row[4]


def corpus(n=300):
    rng = random.Random(8)
    syllables = "the re on in ti er an ha ou st".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(2, 4)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(5, 60))]
        bad = i % 4 == 0
        if bad:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(["zimbork", "quaffel" + word(), "zimbork!"]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return docs, labels


def test_learns_and_tolerates_inserted_characters(spark):
    docs, labels = corpus()
    extra = [(1000, "the rest zimxbork on"), (1001, "the z i m b o r k on"), (1002, "there onthe resti"), (1003, None), (1004, ""),
             (1005, "quaffelishly " * 3000), (None, "zimbork"), (0, docs[0][1])]
    table = helpers.documents(spark, docs + extra).repartition(3)
    known = spark.createDataFrame([*labels, (0, 0), (None, 1), (5, None)], "doc_id bigint, toxic int")
    got = toxicity(table, known, F.col("doc_id") % 5 != 0, column="score")
    assert got.columns == [*table.columns, "score"] and got.count() == len(docs) + len(extra)
    scores = {(r.doc_id, r.text): r.score for r in got.collect()}
    held = [(scores[i, t] >= 0.5) == (i % 4 == 0) for i, t in docs if i % 5 == 0]
    assert sum(held) >= 0.95 * len(held)
    score = {i: scores[i, t] for i, t in extra}
    assert all(score[i] >= 0.5 for i in (1000, 1001, 1005, None)) and all(score[i] < 0.5 for i in (1002, 1003, 1004))
    assert score[1003] == score[1004] and all(0 <= s <= 1 for s in scores.values())


def test_without_examples(spark):
    docs = helpers.documents(spark, [(1, "a b"), (2, None)])
    labels = spark.createDataFrame([(1, 0)], "doc_id bigint, toxic int")
    for own in (labels, labels.limit(0)):
        assert [r.toxicity for r in toxicity(docs, own, F.lit(True)).collect()] == [0.0, 0.0]
    assert toxicity(docs.limit(0), labels, F.lit(True)).count() == 0


def test_a_task_compares_a_fragment_once(monkeypatch):
    model, texts = Model([" idiot", "scum"], np.array([2.0, 1.0]), -1.0), ["you idiot and scum", "an idiXot", "", None, "scum " + "i" * 60]
    marks, known, asked = Landmarks(model.landmarks), {}, []
    want = model.documents(pa.array(texts, pa.string()), marks)
    decide = Model.decisions
    monkeypatch.setattr(Model, "decisions", lambda self, strings, marks: asked.extend(strings) or decide(self, strings, marks))
    for _ in range(2):
        assert np.allclose(model.documents(pa.array(texts, pa.string()), marks, known), want, rtol=1e-6)
    assert len(asked) == len(set(asked)) + 1  # the long fragment is not kept
    monkeypatch.setattr("salescast.llm.toxicity.KNOWN", 0)
    assert np.allclose(model.documents(pa.array(texts, pa.string()), marks, {}), want, rtol=1e-6)
