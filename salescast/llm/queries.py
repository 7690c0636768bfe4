"""The registered queries of this package: whole tables, production parameters."""

from __future__ import annotations

import base64
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.llm.bpe import round_trip
from salescast.llm.conversations import digests
from salescast.llm.decontamination import contamination
from salescast.llm.html_text import extract
from salescast.llm.licenses import scan_licences
from salescast.llm.lm import lattice_scores
from salescast.llm.mixing import mix, taken_sizes, words
from salescast.llm.near_dedup import near_duplicates
from salescast.llm.quality import quality
from salescast.llm.secret_scan import BASE, secret_spans
from salescast.llm.sharding import shards
from salescast.llm.toxicity import toxicity
from salescast.llm.whitening import whiten


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_ranks(path: str | None = None) -> dict[bytes, int]:
    """The byte-level vocabulary of a rank file; by default the public one for many languages."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


def remainder(n: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(remainder(5) == 0, F.lit(False))
    found = toxicity(documents, table(spark, sf_dir, "labels"), ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), F.col("toxicity").alias("score"),
                        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licences(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", *(f"licences.{c}" for c in ("n_words", "n_base", "first_word", "last_word")),
                        F.concat_ws(",", "licences.base_labels").alias("base_labels"),
                        F.concat_ws(",", "licences.labels").alias("labels"), "licences.score")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(documents, byte_ranks(), public_tokenizers.PATTERN)


def _whether(kind: str) -> Callable[[Column], Column]:
    """A function of a span: true if it is of the kind, else null."""
    return lambda span: F.when(span["kind"] == kind, F.lit(True))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    joined = lambda spans: F.concat_ws(",", F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    counts = [F.size(F.array_compact(F.transform("spans", _whether(kind)))).cast("long").alias(f"n_{kind}") for kind in BASE]
    base = joined(F.filter("spans", lambda s: s["kind"].isin(*BASE)))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances in millionths, so that engines whose logarithms differ in the last bit agree."""
    found = quality(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return found.withColumns({c: F.round(c, 6) for c in ("char_distance", "word_distance")})


def op9_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_scores(table(spark, sf_dir, "documents"), byte_ranks(), remainder(7) == 2)


def op10_extendible_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in shards of at most a mebibyte of text."""
    found = shards(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"], limit=1 << 20)
    return found.select("doc_id", "bytes", "shard", "depth", "shard_bytes")


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix is planned on sizes; texts stand for themselves by a hash, as only their place in the mix is asked for."""
    documents = table(spark, sf_dir, "documents")
    rows = documents.select("doc_id", "source", words(F.col("text")).alias("size"), F.xxhash64("text").alias("text"))
    return taken_sizes(mix(rows)).select("doc_id", "size", "source_size", "target", "taken")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "conversations"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_near_dedup": op2_near_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_html_text": op4_html_text,
    "op5_license_scan": op5_license_scan,
    "op6_byte_bpe": op6_byte_bpe,
    "op7_secret_scan": op7_secret_scan,
    "op8_quality_rules": op8_quality_rules,
    "op9_lattice_lm": op9_lattice_lm,
    "op10_extendible_shards": op10_extendible_shards,
    "op11_source_mix": op11_source_mix,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_whitening": op13_whitening,
}
