import random
import zlib

import corpus_pipeline
import helpers
import pytest
from pyspark.sql import functions as F
from test_near_dedup import shingles

from salescast.llm.queries import byte_ranks

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A small corpus with toxic texts, copies, benchmark passages, secrets and awkward rows."""
    folder = tmp_path_factory.mktemp("corpus")
    rng = random.Random(11)
    syllables = "the re on in ti er an ha ou st".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    text = lambda n: " ".join(word() for _ in range(n))
    docs = {i: text(rng.randint(20, 80)) for i in range(200)}
    toxic = {i for i in docs if i % 5 == 3}
    for i in toxic:
        docs[i] += f" zimbork and zimbork{word()} again"
    item = text(12)
    docs[201], docs[202], docs[203] = docs[1], docs[1] + " more", f"{text(9)} {item} {text(5)}"
    docs[204], docs[205], docs[206] = f"{text(30)} password = hunter2hunter2 {text(3)}", "", None
    rows = [(i, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, t in docs.items()]
    rows += [(None, text(30), "en", "s", 1), (10, text(40), "en", "s", 1), rows[12]]
    labels = [(i, 1, int(i in toxic)) for i in range(200)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(folder / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
    spark.createDataFrame([(7, item)], "item_id int, text string").write.parquet(str(folder / "benchmark.parquet"))
    return str(folder), rows, toxic, item


def stage(spark, tables, name, docs=None):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet") if docs is None else docs
    return docs, dict(corpus_pipeline.STAGES)[name](spark, docs, tables[0])


def test_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "secrets", "byte_bpe"]


def test_toxic_documents_go(spark, tables):
    docs, kept = stage(spark, tables, "toxicity")
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    held = {i for i in tables[2] if zlib.crc32(str(i).encode()) % 5 == 0}
    assert held and len(held & set(ids)) <= 0.1 * len(held)
    assert len(ids) >= docs.count() - len(tables[2]) - 3 and None in ids and {205, 206} <= set(ids)


def test_one_of_each_group_stays(spark, tables):
    docs, kept = stage(spark, tables, "near_dedup")
    assert kept.columns == docs.columns
    rows = sorted(((r.doc_id is None, r.doc_id or 0), r.text) for r in docs.collect())
    want, seen = [], []
    for key, text in rows:  # groups here are copies of one text, so the first of each is the one to keep
        own = shingles(text)
        if not own or not any(100 * len(own & s) >= 85 * len(own | s) for s in seen):
            want.append((key, text))
        seen.append(own) if own else None
    assert sorted((((r.doc_id is None, r.doc_id or 0), r.text) for r in kept.collect()), key=repr) == sorted(want, key=repr)


def test_contaminated_documents_go(spark, tables):
    docs, kept = stage(spark, tables, "decontamination")
    item = helpers.letters(tables[3])
    windows = {tuple(item[k: k + 10]) for k in range(len(item) - 9)}
    clean = [r for r in docs.collect() if not windows & {tuple(helpers.letters(r.text)[k: k + 10]) for k in range(len(helpers.letters(r.text)))}]
    assert sorted(kept.collect(), key=repr) == sorted(clean, key=repr) and len(clean) == docs.count() - 1


def test_secrets_are_redacted(spark, tables):
    docs, kept = stage(spark, tables, "secrets")
    assert kept.columns == docs.columns and kept.count() == docs.count()
    (row,) = kept.where("doc_id = 204").collect()
    assert "hunter2" not in row.text and "[secret]" in row.text and row.n_chars == len(row.text)
    assert kept.where("doc_id <> 204").exceptAll(docs).count() == 0


def test_tokens(spark, tables):
    tiktoken, public = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    docs, out = stage(spark, tables, "byte_bpe")
    theirs = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=byte_ranks(), special_tokens={}).encode_ordinary
    want = sorted(theirs(r.text or "") for r in docs.select("text").collect())
    got = out.collect()
    assert sorted(list(r.ids) for r in got) == want and all(r.n_tokens == len(r.ids) for r in got)


def test_clashing_columns_and_empty_tables(spark, tables):
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    for name, function in corpus_pipeline.STAGES:
        more = docs.withColumns({c: F.lit("own") for c in ("toxicity", "spans", "row_number", "row_key", "score", "component_id")})
        out = function(spark, more, tables[0])
        assert out.select("spans", "toxicity", "row_key").distinct().collect() == [("own", "own", "own")]
        assert function(spark, docs.limit(0), tables[0]).count() == 0


def test_whole_run(spark, tables):
    got = corpus_pipeline.run(spark, tables[0])
    assert {"doc_id", "ids", "n_tokens"} <= set(got.columns) and 100 < got.count() < 170
    assert not {r.doc_id for r in got.collect()} & {201, 202, 203}


def test_near_copies_from_a_similarity_of_four_fifths(spark, tables):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    docs, pairs = [], {}
    for k in range(30):  # each change of one word takes five of 196 shingles away and brings five
        base = [word() for _ in range(200)]
        copy = list(base)
        for i in range(rng.choice([3, 4, 5])):
            copy[10 + 20 * i] = word()
        a, b = (shingles(" ".join(t)) for t in (base, copy))
        pairs[k] = len(a & b) / len(a | b)
        docs += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(copy))]
    assert any(0.8 <= s < 0.85 for s in pairs.values()) and any(s < 0.8 for s in pairs.values()) and any(s >= 0.85 for s in pairs.values())
    _, kept = stage(spark, tables, "near_dedup", helpers.documents(spark, docs))
    want = {i for k, s in pairs.items() for i in (2 * k, *((2 * k + 1,) if s < 0.8 else ()))}
    assert {r.doc_id for r in kept.collect()} == want
