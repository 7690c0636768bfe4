"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear support vector machine.

A document's sentences are taken as fragments: each word, and words that only marks or single letters split (``i.d.i.o.t``,
``i d i o t``) joined. A fragment is compared with the landmarks by the gap-weighted subsequence kernel, so an insult with
inserted characters or endings still resembles its landmark. A document's score
rests on its worst fragments.

Training takes at most ``SAMPLE`` labelled documents of each class (a documented bound), those whose ids hash lowest. Labels
of documents become labels of fragments: strings that occur in many toxic and hardly in clean documents become landmarks
until every toxic document holds some (``COVER`` of them where it can); fragments with one are the positive examples, and
fragments of clean documents the negative ones, the most similar first; the worst of those are landmarks too. The machine
is fitted on Nyström features, and the worst decisions in each document of the sample are turned into a probability by
logistic regression, with the classes as frequent as among all labels.

Edge cases: null and empty texts have no fragment and get the score of an empty text. Without toxic or clean examples the
score is 0. Several labels of one id count as toxic if one is; null ids and null labels teach nothing. Repeated rows are
answered row by row. Texts are read whole; a long fragment is compared by overlapping windows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.llm.string_kernel import LENGTH, WIDEST, Landmarks, windows
from salescast.llm.text import LETTERS, SPACED, Words, runs
from salescast.session import materialize

#: Labelled documents of each class that are used for training.
SAMPLE = 2500
#: Landmarks of insults and of clean fragments, at most.
INSULTS, OTHERS = 48, 12
COVER = 3
NEGATIVES = 5000
#: Characters of the strings that are counted to find landmarks.
GRAMS = (4, 5, 6)
#: The highest decisions of a document that count for its score.
WORST = 3
#: Bytes of text whose distinct fragments a task compares at once; more of it repeats itself more, but takes more memory.
RUN = 4 << 20
#: Short fragments whose decisions a task keeps from run to run; further ones are compared again.
KNOWN = 400_000


def fragments(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct fragments, each after a space, and for every occurrence its place among them and its row."""
    words = Words(column, LETTERS)
    sample, kind = words.distinct()
    row = words.rows()
    found = [" " + words.word(i).decode("utf-8", "replace") for i in sample]
    if len(words) > 1:
        gap = words.start[1:] - words.end[:-1]
        # One character: its first byte tells how many there are.
        size, lead = words.end - words.start, words.data[words.start]
        one = size == np.where(lead < 0xC0, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
        solid = SPACED[words.data[words.end[:-1]]] & SPACED[words.data[words.start[1:] - 1]]
        close = (row[1:] == row[:-1]) & (gap <= 2) & (solid | one[1:] & one[:-1])
        place = {f: i for i, f in enumerate(found)}
        edge = np.flatnonzero(np.diff(np.concatenate([[0], close.view(np.int8), [0]])))
        more, of = [], []
        for begin, end in edge.reshape(-1, 2):
            joined = " " + b"".join(words.word(i) for i in range(begin, end + 1)).decode("utf-8", "replace")
            more.append(place.setdefault(joined, len(place)))
            of.append(row[begin])
        found = list(place)
        kind = np.concatenate([kind, np.array(more, np.int64)])
        row = np.concatenate([row, np.array(of, np.int64)])
    return found, kind, row


class Model:
    """Decision of a fragment: a weighted sum of its kernel values and a constant; ``curve`` makes a document's score."""

    def __init__(self, landmarks: list[str], weights: np.ndarray, constant: float):
        self.landmarks, self.weights, self.constant = landmarks, weights, constant
        self.curve = np.zeros(WORST + 2)

    def remembered(self, strings: list[str], marks: Landmarks, known: dict[str, float]) -> np.ndarray:
        """The decisions of fragments, those of earlier runs from ``known``, which takes up to ``KNOWN`` of the new ones."""
        new = [s for s in strings if s not in known]
        found = dict(zip(new, self.decisions(new, marks).tolist()))
        value = np.array([known[s] if s in known else found[s] for s in strings], float)
        known.update(islice(((s, v) for s, v in found.items() if len(s) <= WIDEST), max(0, KNOWN - len(known))))
        return value

    def decisions(self, strings: list[str], marks: Landmarks) -> np.ndarray:
        parts = [windows(s) for s in strings]
        flat = [p for own in parts for p in own]
        value = np.concatenate([marks.compare(flat[k: k + 100_000]) @ self.weights for k in range(0, len(flat), 100_000)]
                               or [np.zeros(0)]) + self.constant
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        return np.maximum.reduceat(value, np.cumsum(sizes) - sizes) if len(parts) else value

    def documents(self, column: pa.Array, marks: Landmarks, known: dict[str, float] | None = None) -> np.ndarray:
        """For each row its ``WORST`` largest decisions, the logarithm of its number of fragments, and 1.

        With ``known``, decisions of fragments are kept there for the next call.
        """
        found, kind, row = fragments(column)
        out = np.full((len(column), WORST + 2), self.constant)
        out[:, -2] = np.log1p(np.bincount(row, minlength=len(column)))
        out[:, -1] = 1
        value = (self.decisions(found, marks) if known is None else self.remembered(found, marks, known))[kind]
        high = np.flatnonzero(value > self.constant + 1e-6)
        row, value = row[high], value[high]
        order = np.lexsort((-value, row))
        row, value = row[order], value[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        kept = rank < WORST
        out[row[kept], rank[kept]] = value[kept]
        return out

    def scores(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.curve, -30, 30)))


def _map(rows: DataFrame, kind: str, function) -> DataFrame:
    """``function`` on every run of rows (with a text column) by Arrow."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(batch, "text", RUN):
                yield function(part)

    return rows.mapInArrow(apply, kind)


def _sample(documents: DataFrame, labels: DataFrame, allowed: Column, most: int) -> tuple[DataFrame, float]:
    """doc_id, text, toxic of the training documents, and the share of toxic ones among all labels."""
    known = (labels.where("doc_id is not null and toxic is not null").where(allowed)
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")))
    # Labels without a document would only take places away.
    known = known.join(documents.select("doc_id").distinct(), "doc_id", "left_semi")
    known = materialize(known, "labels")
    parts = [known.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most) for t in (0, 1)]
    chosen = materialize(parts[0].unionByName(parts[1]), "sample-ids")
    sample = materialize(documents.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic"), "sample")
    return sample, known.agg(F.coalesce(F.avg("toxic"), F.lit(0.0))).first()[0]


def _grams(part: pa.RecordBatch) -> pa.RecordBatch:
    """Strings of ``GRAMS`` characters with the number of toxic and clean documents that hold them."""
    found, kind, row = fragments(part["text"])
    toxic = part["toxic"].to_numpy()
    count = (Counter(), Counter())
    own = [{f[k: k + n] for n in GRAMS for k in range(len(f) - n + 1)} for f in found]
    pairs = np.unique(row * (len(found) + 1) + kind) if len(row) else row
    for i in np.unique(row):
        low, high = np.searchsorted(pairs, [i * (len(found) + 1), (i + 1) * (len(found) + 1)])
        count[toxic[i]].update(set().union(*(own[k] for k in pairs[low: high] - i * (len(found) + 1))))
    grams = list(count[0].keys() | count[1].keys())
    return pa.RecordBatch.from_pydict({
        "gram": pa.array(grams, pa.string()), "toxic": pa.array([count[1][g] for g in grams], pa.int64()),
        "clean": pa.array([count[0][g] for g in grams], pa.int64())})


def _choose(sample: DataFrame, toxic: int, clean: int) -> list[str]:
    """Strings that mark toxic documents: the one that most documents still lack comes first, then the longer one."""
    counts = _map(sample, "gram string, toxic long, clean long", _grams).groupBy("gram").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # The lower end of the log odds, so that a rare string is no accident.
    up, down = F.col("toxic") + 0.5, F.col("clean") + 0.5
    weight = F.log(up / down * (clean + 1) / (toxic + 1)) - 2 * F.sqrt(1 / up + 1 / down)
    best = (counts.where("toxic > 1").withColumn("weight", weight).where("weight > 1")
            .orderBy(F.desc(F.col("weight") * F.sqrt("toxic")), "gram").limit(3000).collect())
    weights = {r.gram: r.weight for r in best}

    def held(part: pa.RecordBatch) -> pa.RecordBatch:
        found, kind, row = fragments(part["text"])
        own = [{f[k: k + n] for n in GRAMS for k in range(len(f) - n + 1)} & weights.keys() for f in found]
        sets = [set() for _ in range(part.num_rows)]
        for k, i in zip(kind, row):
            sets[i] |= own[k]
        return pa.RecordBatch.from_pydict({"grams": pa.array([sorted(s) for s in sets], pa.list_(pa.string()))})

    documents = [set(r.grams) for r in _map(sample.where("toxic = 1"), "grams array<string>", held).toLocalIterator()]
    left, chosen = [COVER] * len(documents), []
    at = {}
    for i, grams in enumerate(documents):
        for g in grams:
            at.setdefault(g, []).append(i)
    while at and len(chosen) < INSULTS:
        gain = {g: sum(left[i] > 0 for i in own) for g, own in at.items()}
        best = max(gain, key=lambda g: (gain[g] * weights[g], len(g), g))
        if gain[best] < max(2, toxic // 500):
            break
        chosen.append(best)
        for i in at[best]:
            left[i] -= 1
        core = {best[k: k + 3] for k in range(len(best) - 2)}
        at = {g: own for g, own in at.items() if not any(c in g for c in core)}
    return chosen


def _grow(grams: list[str], words: list[tuple[str, int]]) -> list[str]:
    """Each string with the characters that nearly all its occurrences have before and after it, up to 16."""
    out = []
    for gram in grams:
        held = [(w, n) for w, n in words if gram in w]
        grown = True
        while grown and len(gram) < 16:
            grown = False
            for side in (-1, 1):
                near = Counter()
                for w, n in held:
                    at = w.find(gram)
                    near[(w[at - 1: at] if side < 0 else w[at + len(gram): at + len(gram) + 1])] += n
                char, n = max(near.items(), key=lambda x: (x[1], x[0])) if near else ("", 0)
                if char and n >= 0.9 * sum(near.values()) and len(gram) < 16:
                    gram = char + gram if side < 0 else gram + char
                    held, grown = [(w, m) for w, m in held if gram in w], True
        if gram not in out:
            out.append(gram)
    return out


def _machine(features: np.ndarray, toxic: np.ndarray, cost: float = 10.0, steps: int = 50) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge loss by Newton steps; both classes weigh the same."""
    sign = np.where(toxic, 1.0, -1.0)
    each = np.where(toxic, 0.5 / max(1, toxic.sum()), 0.5 / max(1, (~toxic).sum())) * len(sign) * cost
    x = np.hstack([features, np.ones((len(features), 1))])
    ridge = np.eye(x.shape[1])
    ridge[-1, -1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        active = sign * (x @ w) < 1
        a, c = x[active], each[active]
        new = np.linalg.solve(ridge + (a * c[:, None]).T @ a, (a * (c * sign[active])[:, None]).sum(axis=0))
        if np.allclose(new, w, atol=1e-9):
            break
        w = new
    return w[:-1], float(w[-1])


def _curve(features: np.ndarray, toxic: np.ndarray, share: float) -> np.ndarray:
    """Logistic regression with smoothed targets; ``share`` of the documents are toxic."""
    up, down = toxic.sum(), (~toxic).sum()
    goal = np.where(toxic, (up + 1) / (up + 2), 1 / (down + 2))
    each = np.where(toxic, share / up, (1 - share) / down)
    w = np.zeros(features.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        ridge = 1e-5 * np.eye(len(w))
        step = np.linalg.solve((features * (each * p * (1 - p))[:, None]).T @ features + ridge,
                               features.T @ (each * (p - goal)) + ridge @ w)
        step *= min(1, 2 / max(1e-9, abs(step).max()))
        w = w - step
        if abs(step).max() < 1e-8:
            break
    return w


def train(documents: DataFrame, labels: DataFrame, allowed: Column, most: int = SAMPLE) -> Model | None:
    """A model from the labels (doc_id, toxic) that ``allowed`` (a condition on doc_id) admits; None without examples."""
    sample, share = _sample(documents, labels, allowed, most)
    counts = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts.get(0) or not counts.get(1):
        return None
    grams = _choose(sample, counts[1], counts[0])
    if not grams:
        return None

    def hits(part: pa.RecordBatch) -> pa.RecordBatch:
        found, kind, row = fragments(part["text"])
        good = np.array([any(g in f for g in grams) for f in found], bool)
        pairs = np.unique(np.stack([kind[good[kind]], row[good[kind]]]), axis=1)
        number, n = np.unique(pairs[0], return_counts=True)
        return pa.RecordBatch.from_pydict({"word": pa.array([found[i] for i in number], pa.string()), "n": pa.array(n)})

    top = lambda rows: [(r.word, r.n) for r in (
        _map(rows, "word string, n long", hits).groupBy("word").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "word").limit(NEGATIVES).collect())]
    insults = top(sample.where("toxic = 1"))
    in_clean = dict(top(sample.where("toxic = 0")))
    insults = [(w, n) for w, n in insults if n > 2 * in_clean.get(w, 0) * counts[1] / counts[0]]
    marked = _grow(grams, insults)
    positive = sorted({p for w, _ in insults for p in windows(w) if any(g in p for g in grams)} | set(marked))

    def alike(part: pa.RecordBatch) -> pa.RecordBatch:
        found = sorted({p for f in fragments(part["text"])[0] for p in windows(f)})
        value = Landmarks(marked).compare(found).max(axis=1, initial=0)
        keep = np.argsort(-value, kind="stable")[:NEGATIVES]
        return pa.RecordBatch.from_pydict({"word": pa.array([found[i] for i in keep], pa.string()),
                                           "value": pa.array(np.round(value[keep].astype(float), 5))})

    close = (_map(sample.where("toxic = 0"), "word string, value double", alike).distinct()
             .orderBy(F.desc("value"), "word").limit(NEGATIVES).collect())
    known = set(positive)
    negative = [r.word for r in close if r.word not in known]
    others = [w for w in negative if len(w) >= LENGTH and len(w) <= 16][:: max(1, len(negative) // (20 * OTHERS))][:OTHERS]

    marks = Landmarks(marked + [w for w in others if w not in marked])
    gram = marks.compare(marks.strings).astype(float)
    value, vector = np.linalg.eigh((gram + gram.T) / 2)
    root = (vector / np.sqrt(np.maximum(value, 1e-3))) @ vector.T  # the inverse square root, for Nyström features
    examples = marks.compare(positive + negative).astype(float) @ root
    weights, constant = _machine(examples, np.arange(len(examples)) < len(positive))
    model = Model(marks.strings, root @ weights, constant)

    def judge(part: pa.RecordBatch) -> pa.RecordBatch:
        values = model.documents(part["text"], Landmarks(model.landmarks))
        return pa.RecordBatch.from_pydict({"toxic": part["toxic"], "features": pa.array(list(values))})

    judged = _map(sample, "toxic int, features array<double>", judge).toArrow()
    model.curve = _curve(np.array(judged["features"].to_pylist()), judged["toxic"].to_numpy() == 1, share)
    return model


def toxicity(documents: DataFrame, labels: DataFrame, allowed: Column, most: int = SAMPLE,
             column: str = "toxicity") -> DataFrame:
    """All columns of ``documents`` and ``column``, the probability that the text is toxic.

    ``labels`` (doc_id, toxic) are used as far as ``allowed`` admits; language, source and id are no inputs of a score.
    """
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = train(texts, labels, allowed, most)
    if model is None:
        return documents.withColumn(column, F.lit(0.0))

    @F.arrow_udf("double")
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        marks, known = Landmarks(model.landmarks), {}
        for batch in texts:
            rows = pa.RecordBatch.from_arrays([batch], ["text"])
            value = [model.documents(part["text"], marks, known) for part in runs(rows, "text", RUN)]
            yield pa.array(model.scores(np.concatenate(value or [np.zeros(0)])))

    return documents.withColumn(column, score(F.col("text").cast("string")))
