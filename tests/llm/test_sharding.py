import helpers
import pytest
from pyspark.sql import functions as F

from salescast.llm import sharding
from salescast.llm.sharding import shards, write_shards


def check(found, limit, n):
    got = found.toPandas()
    assert len(got) == n
    by = got.groupby("shard").agg(bytes=("bytes", "sum"), rows=("bytes", "count"), said=("shard_bytes", "first"), depth=("depth", "first"))
    assert (by.bytes == by.said).all() and (by.index.str.len() == by.depth).all()
    assert ((by.bytes <= limit) | (by.rows == 1)).all()
    names = sorted(by.index)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    # Only buckets that were too large have been split.
    for name in names:
        if name:
            above = got[got.shard.str.startswith(name[:-1])]
            assert above.bytes.sum() > limit and len(above) > 1
    return by


def test_shards_fit_and_split_only_if_needed(spark):
    rows = spark.range(3000).select("id", F.repeat(F.lit("é"), (F.col("id") % 90).cast("int")).alias("text"), F.lit(1).alias("depth"))
    by = check(shards(rows, ["id"], limit=4000), 4000, 3000)
    assert len(by) > 30 and check(shards(rows, ["id"], limit=1 << 30), 1 << 30, 3000).depth.tolist() == [0]


@pytest.mark.parametrize("held", [sharding.HELD, 0])
def test_hot_key_and_long_rows(spark, monkeypatch, held):
    monkeypatch.setattr(sharding, "HELD", held)
    rows = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
                                    F.lit("x" * 100).alias("text"))
    more = [("big", "y" * 99_999), (None, None), (None, ""), ("", "a")]
    found = shards(rows.unionByName(spark.createDataFrame(more, "k string, text string")), ["k"], limit=5000)
    assert ("BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()) == (held > 0)
    by = check(found, 5000, 4004)
    assert by.bytes.max() == 99_999 and by.depth.max() > 32


def test_empty_table_and_files(spark, tmp_path):
    docs = helpers.documents(spark, [(i, "text " * i) for i in range(50)])
    assert shards(docs.limit(0), ["doc_id"]).count() == 0
    write_shards(docs, ["doc_id"], str(tmp_path / "out"), limit=1000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and set(back.columns) == {*docs.columns, "shard"}
    sizes = back.groupBy("shard").agg(F.sum(F.octet_length("text")).alias("n"))
    assert sizes.where("n > 1000").count() == 0
