"""Licence scans by ordered signature rules with a keyword prefilter.

The rules of ``license_rules`` are tried on a text only where one of their keywords occurs. Matches are taken from the heaviest rule
down, longer ones first; one whose interval lies within that of a match taken before is suppressed, so the name inside a
notice, or a family inside its version, is not reported again. What is left gives the labels; the score is the chance that
at least one match is right, each right by its weight in a hundred.

Base phrases are looked for in the words of the text and are always reported, whatever the rules suppress.

Edge cases: null and empty texts have no words and no labels, score 0. Texts are read whole. Repeated rows are answered row
by row; a column ``licences`` is replaced.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.llm.license_rules import rules
from salescast.llm.text import LETTERS, Words, runs

#: Phrases of words and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

KIND = ("struct<n_words: bigint, n_base: bigint, first_word: bigint, last_word: bigint, base_labels: array<string>,"
        " labels: array<string>, score: double, matches: array<struct<label: string, start: int, end: int, weight: int>>>")


class Scanner:
    def __init__(self):
        self.by_keywords: dict[tuple[tuple[str, ...], ...], list] = {}
        for number, rule in enumerate(rules()):
            self.by_keywords.setdefault(rule.keywords, []).append((number, rule))

    def matches(self, text: str) -> list[tuple[str, int, int, int]]:
        """What no heavier or longer match contains: label, start, end, weight."""
        low = " ".join(text.lower().split())
        found: dict[int, list[tuple[int, int, int, str]]] = {}
        for keywords, own in self.by_keywords.items():
            if any(all(part in low for part in parts) for parts in keywords):
                for number, rule in own:
                    group = 1 if rule.pattern.groups else 0
                    places = ((*m.span(group), number, rule.label) for m in rule.pattern.finditer(text))
                    found.setdefault(rule.weight, []).extend((start, -end, number, label) for start, end, number, label in places)
        out: list[tuple[str, int, int, int]] = []
        for weight in sorted(found, reverse=True):
            starts, reach = _reach(out)
            most = -1
            # Of one weight the longer ones come first from each start, so what lies in another one ends before the furthest end yet.
            for start, end, _, label in sorted(found[weight]):
                end, at = -end, bisect_right(starts, start)
                if end > most and not (at and reach[at - 1] >= end):
                    out.append((label, start, end, weight))
                most = max(most, end)
        return sorted(out, key=lambda m: m[1:])


def _reach(taken: list[tuple[str, int, int, int]]) -> tuple[list[int], list[int]]:
    """The starts of matches in order, and the furthest end up to each."""
    spans = sorted((start, end) for _, start, end, _ in taken)
    return [start for start, _ in spans], list(accumulate((end for _, end in spans), max))


def _places(words: Words) -> list[tuple[np.ndarray, str]]:
    """The words where a base phrase starts, with its label."""
    hashes, row = words.hashes(), words.rows()
    out = []
    for phrase, label in PHRASES.items():
        wanted = Words(pa.array([phrase]), LETTERS).hashes()
        last = len(hashes) - len(wanted) + 1
        if last <= 0:
            continue
        at = np.flatnonzero(hashes[:last] == wanted[0])
        for k in range(1, len(wanted)):
            at = at[hashes[at + k] == wanted[k]]
        out.append((at[row[at] == row[at + len(wanted) - 1]], label))
    return out


def scan_licences(documents: DataFrame) -> DataFrame:
    """``documents`` with the column ``licences`` (``KIND``): base phrases, and labels with the rules' as well."""

    @F.arrow_udf(KIND)
    def scan(column: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = Scanner()
        for texts in column:
            out = []
            for part in runs(pa.RecordBatch.from_arrays([texts], ["text"]), "text", 8 << 20):
                words = Words(part["text"], LETTERS)
                row, n = words.rows(), np.diff(words.first)
                base: dict[int, list] = {}
                for at, label in _places(words):
                    for place in at.tolist():
                        base.setdefault(int(row[place]), []).append((place - int(words.first[row[place]]), label))
                for i, text in enumerate(part["text"].to_pylist()):
                    own = sorted(base.get(i, ()))
                    labels = sorted({label for _, label in own})
                    matches = scanner.matches(text) if text else []
                    wrong = 0.0 if own else 1.0
                    for match in matches:
                        wrong *= 1 - match[3] / 100
                    out.append({
                        "n_words": int(n[i]), "n_base": len(own), "first_word": own[0][0] if own else None,
                        "last_word": own[-1][0] if own else None, "base_labels": labels,
                        "labels": sorted({*labels, *(m[0] for m in matches)}), "score": 1 - wrong,
                        "matches": [dict(zip(("label", "start", "end", "weight"), m)) for m in matches]})
            yield pa.array(out, TYPE)

    return documents.withColumn("licences", scan(F.col("text").cast("string")))


_MATCH = pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("weight", pa.int32())])
TYPE = pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                  ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("score", pa.float64()),
                  ("matches", pa.list_(_MATCH))])
