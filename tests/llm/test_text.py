import random

import helpers
import numpy as np
import pyarrow as pa
import pytest

from salescast.llm.text import LETTERS, SPACED, Words, runs


@pytest.mark.parametrize("kind, plain", [(SPACED, helpers.spaced), (LETTERS, helpers.letters)])
def test_words_equal_the_pattern(kind, plain):
    rng = random.Random(1)
    texts = ["".join(rng.choice("aB1 \n\t.é日x\x0b-\x00") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    texts += [None, "", "x" * 700, " ", "a"]
    column = pa.array(texts).slice(2)
    words = Words(column, kind)
    seen = {}
    hashes = words.hashes()
    for i, text in enumerate(texts[2:]):
        own = range(words.first[i], words.first[i + 1])
        assert [words.word(j).decode() for j in own] == plain(text)
        for j in own:
            assert seen.setdefault(words.word(j), hashes[j]) == hashes[j]
    assert len(set(seen.values())) == len(seen)
    sample, number = words.distinct()
    column = words.binary(sample)
    assert all(column[int(number[j])].as_py() == words.word(j) for j in range(len(words)))


def test_runs_hold_all_rows_in_order():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["a" * n for n in (5, 50, 1, 1, 0, 30)] + [None]), "i": list(range(7))})
    parts = list(runs(batch, "text", 10))
    assert [i for p in parts for i in p["i"].to_pylist()] == list(range(7))
    assert [p.num_rows for p in parts] == [1, 1, 3, 1, 1]
    assert list(runs(batch.slice(0, 0), "text")) == []


def test_empty_column():
    words = Words(pa.array([], pa.string()), SPACED)
    assert len(words) == 0 and words.hashes().dtype == np.uint64
