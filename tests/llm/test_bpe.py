import hashlib
import random

import helpers
import pytest

from salescast.llm import bpe
from salescast.llm.bpe import Codec, _Chunk, decode, encode, round_trip, stitch
from salescast.llm.queries import byte_ranks

tiktoken = pytest.importorskip("tiktoken")
public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def ranks():
    return byte_ranks()


@pytest.fixture(scope="module")
def theirs(ranks):
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def texts(n, seed=5):
    rng = random.Random(seed)
    parts = ["a", "the", " ", "  ", "\n", "'re", "'r", "1", "é", "日本", "!", ".", "x" * 7, "\t", "'s", "  \n", "🎉", "\x1c", "<|endoftext|>"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_ids_equal_the_library(ranks, theirs):
    codec = Codec(ranks, public.PATTERN)
    all_ = [*texts(500), "ab" * 500, "日" * 400, "x" * 5000, " " * 3000 + "a", "!?" * 900]
    assert [list(ids) for ids in codec.all_ids(all_)] == [theirs(text) for text in all_]


def test_merges_together_equal_the_library(ranks, theirs):
    rng = random.Random(3)
    tokens = {"".join(rng.choice("aabcdeinorstz éж日") for _ in range(rng.randint(1, 30))).replace(" ", "") or "q" for _ in range(4000)}
    codec = Codec(ranks, public.PATTERN)
    codec.learn(tokens)
    assert all(list(codec[t]) == theirs(t) for t in tokens if public_single(t))


def public_single(token):
    """Whether the pattern leaves it whole."""
    import regex

    return regex.findall(public.PATTERN, token) == [token]


def test_what_is_remembered_is_bounded(ranks, theirs, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    codec = Codec(ranks, public.PATTERN)
    for k in range(0, 400, 40):
        some = [f"{t} word{k}x" for t in texts(40, k)]
        assert [list(ids) for ids in codec.all_ids(some)] == [theirs(t) for t in some]


@pytest.mark.parametrize("size, overlap", [(8, 6), (5, 4), (13, 20)])
def test_stitching_anywhere(ranks, theirs, size, overlap):
    codec = Codec(ranks, public.PATTERN)
    for text in texts(400):
        count = max(1, -(-(len(text) - overlap) // size))
        parts = [(k * size, text[k * size: (k + 1) * size + overlap]) for k in range(count)]
        assert list(stitch([_Chunk(at, t, *codec.pieces(t)) for at, t in parts], codec)) == theirs(text)


def test_documents_round_trip(spark, ranks, theirs):
    docs = [*enumerate(texts(60, 9)), (100, None), (101, ""), (None, "a b"), (102, "word " * 3000), (102, "x" * 4000), (102, "x" * 4000)]
    table = helpers.documents(spark, docs).repartition(3)
    found = encode(table, ranks, public.PATTERN, chunk=40, overlap=12)
    assert found.columns == [c for c in table.columns if c != "text"] + ["ids"]
    got = decode(found, ranks, to="back").collect()
    key = lambda r: repr((r[0], r[1]))
    assert sorted(((r.doc_id, list(r.ids)) for r in got), key=key) == sorted(((i, theirs(t or "")) for i, t in docs), key=key)
    assert sorted(bytes(r.back).decode() for r in got) == sorted(t or "" for _, t in docs)


def test_digests_are_those_of_ids_and_texts(spark, ranks, theirs, monkeypatch):
    docs = [*enumerate(texts(60, 9)), (100, None), (101, ""), (None, "a b"), (102, "word " * 3000), (102, "x" * 4000)]
    table = helpers.documents(spark, docs).repartition(3)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for chunk, overlap in ((40, 12), (32768, 1024)):
        found = round_trip(table, ranks, public.PATTERN, chunk, overlap)
        got = sorted((repr(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found.collect())
        assert got == sorted((repr(i), len(theirs(t or "")), sha(",".join(map(str, theirs(t or ""))).encode()), sha((t or "").encode()))
                             for i, t in docs)


def test_long_texts_are_decoded_in_several_batches(spark, ranks, monkeypatch):
    docs = [(i, "some words " * 300_000) for i in range(3)] + [(3, None), (4, "a")]
    back = decode(encode(helpers.documents(spark, docs).coalesce(1), ranks, public.PATTERN), ranks).select("doc_id", "decoded")
    assert {r.doc_id: bytes(r.decoded).decode() for r in back.collect()} == {i: t or "" for i, t in docs}


def test_empty_table(spark, ranks):
    assert encode(helpers.documents(spark, []), ranks, public.PATTERN).count() == 0
