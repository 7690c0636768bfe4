import math
import random
from collections import Counter

import helpers
from pyspark.sql import functions as F

from salescast.llm import quality as rules
from salescast.llm.quality import common_words, jensen_shannon, quality


def plain(text):
    text = text or ""
    words = helpers.SPACED.findall(text)
    lines = [line for line in text.split("\n") if helpers.SPACED.search(line)]
    windows = [tuple(words[k: k + 5]) for k in range(len(words) - 4)]
    often = Counter(windows)
    again = {i for k, w in enumerate(windows) if often[w] > 1 for i in range(k, k + 5)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again),
            n < 10 or 100 * len(again) > 20 * n)


def made():
    rng = random.Random(4)
    clean = lambda n: " ".join(rng.choice("the of and house tree river walks slowly again under".split()) for _ in range(n)).capitalize() + "."
    docs = [(i, " ".join(clean(12) + str(i) for _ in range(1)) + "\n" + "".join(f"{clean(rng.randint(3, 9))} n{i}k{k} " for k in range(30))) for i in range(60)]
    return clean, docs


def test_counts_equal_brute_force(spark):
    rng = random.Random(7)
    docs = [(i, "".join(rng.choice(["a ", "b ", "c\n", "#", "é ", "\t", "\n", "\x0b", " \x85"]) for _ in range(rng.randint(0, 90)))) for i in range(80)]
    docs += [(100, None), (101, ""), (102, " \n "), (None, "a b c d e a b c d e"), (103, "w " * 6000), (103, "x\nx\n x\nx"), (103, "x\nx\n x\nx")]
    got = quality(helpers.documents(spark, docs).repartition(3)).collect()
    assert sorted(((r[0], *r[1:7]) for r in got), key=repr) == sorted(((i, *plain(t)) for i, t in docs), key=repr)
    assert not any(r.kept for r in got if r.base_failed)


def test_divergent_texts_fail_and_clean_ones_stay(spark):
    clean, docs = made()
    bad = [(900, " | ".join(f"{clean(1).upper()}!!{k}" for k in range(60))), (901, " ".join(f"{k * 7919}" for k in range(200)))]
    short = [(902, "THE OF AND HOUSE TREE! RIVER? WALKS 1 2 3")]
    kept = {r.doc_id: r.kept for r in quality(helpers.documents(spark, docs + bad + short)).collect()}
    assert all(kept[i] for i, _ in docs) and not kept[900] and not kept[901] and kept[902]


def test_distance(spark):
    pairs = [([0.5, 0.5], [0.5, 0.5]), ([1.0, 0.0], [0.0, 1.0]), ([0.7, 0.2, 0.1], [0.1, 0.3, 0.6])]
    df = spark.createDataFrame(pairs, "a array<double>, b array<double>")
    for (p, q), got in zip(pairs, df.select(jensen_shannon(F.col("a"), F.col("b")).alias("d")).collect()):
        half = lambda x, y: sum(u * math.log2(2 * u / (u + v)) for u, v in zip(x, y) if u)
        assert abs(got.d - math.sqrt((half(p, q) + half(q, p)) / 2)) < 1e-12


def test_languages_and_empty_table(spark):
    docs = helpers.documents(spark, made()[1])
    mixed = docs.withColumn("lang", F.when(F.col("doc_id") < 20, F.lit(None)).otherwise(F.lit("de")))
    assert quality(mixed).where("kept").count() == 60
    assert quality(docs.limit(0)).count() == 0


def test_common_words_of_any_length(spark):
    rng = random.Random(8)
    words = ["nicht", "werden", "zwischen", "Verantwortlichkeiten", "und"]
    docs = [(i, " ".join(rng.choice(words) + f" w{i}x{k}" for k in range(60))) for i in range(20)]
    (row,) = common_words(helpers.documents(spark, docs)).collect()
    often = Counter(w.lower() for _, t in docs for w in t.split())
    n = sum(often.values())
    want = {w: c / n for w, c in often.items() if c >= 0.005 * n}
    assert dict(zip(row.common, row.word_shares)) == want and {w.lower() for w in words} <= set(want)
    odd = [(900, " ".join(f"y{k} z{k}" for k in range(200)))]  # none of the common words, which are mostly long
    kept = {r.doc_id: r.word_distance for r in quality(helpers.documents(spark, docs + odd)).collect()}
    assert kept[900] > 0.5 > max(d for i, d in kept.items() if i != 900)


def verdicts(docs):
    """Both distances and the verdict of (doc_id, text) rows of one language, written out."""
    marks = {"upper": set("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "digit": set("0123456789"), "stop": set(".,;:?!'\"()-"), "symbol": set("#*$%&|<>")}

    def histogram(text):
        counts = [sum(c in own for c in text) for own in marks.values()]
        counts += [sum(c in " \t\n\x0b\f\r" for c in text), len(text.encode()) - len(text)]
        return [*counts, len(text.encode()) - sum(counts)]

    def distance(p, q):
        half = lambda x, y: sum(u * math.log2(2 * u / (u + v)) for u, v in zip(x, y) if u > 0)
        return math.sqrt(max(0.0, (half(p, q) + half(q, p)) / 2))

    texts = [t or "" for _, t in docs]
    sums = [sum(column) for column in zip(*map(histogram, texts))]
    chars = [s / max(1, sum(len(t.encode()) for t in texts)) for s in sums]
    often = Counter(w.lower() for t in texts for w in helpers.SPACED.findall(t))
    common = {w: n / often.total() for w, n in sorted(often.items()) if n >= rules.COMMON * often.total()}
    out = []
    for (i, _), text in zip(docs, texts):
        words, size = [w.lower() for w in helpers.SPACED.findall(text)], len(text.encode())
        char = word = None
        if size >= rules.LEAST_BYTES:
            char = distance([c / size for c in histogram(text)], chars)
        if len(words) >= rules.LEAST_WORDS and common:
            own = [words.count(w) / len(words) for w in common]
            word = distance([*own, 1 - sum(own)], [*common.values(), 1 - sum(common.values())])
        far = (char is not None and char > rules.CHAR_LIMIT + rules.CHAR_NOISE / math.sqrt(size)
               or word is not None and word > rules.WORD_LIMIT + rules.WORD_NOISE / math.sqrt(len(words)))
        out.append((i, char, word, not plain(text)[5] and not far))
    return out


def test_verdict_equals_brute_force(spark):
    clean, docs = made()
    rng = random.Random(11)
    docs += [(200 + i, " ".join(rng.choice(["the", "of", "X9#", "||", "zé", "AND", "12", f"u{k}"]) for k in range(rng.randint(5, 200)))) for i in range(60)]
    docs += [(900, None), (901, ""), (902, "w " * 3000), (903, "Same words here. " * 4)]
    got = {r.doc_id: r for r in quality(helpers.documents(spark, docs)).collect()}
    near = lambda a, b: a is b is None or abs(a - b) < 1e-9
    for i, char, word, kept in verdicts(docs):
        assert near(got[i].char_distance, char) and near(got[i].word_distance, word) and got[i].kept == kept
    assert 0 < sum(r.kept for r in got.values()) < len(got)
