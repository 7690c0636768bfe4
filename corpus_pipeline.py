"""A corpus cleaned for training, in five stages: toxicity, near duplicates, benchmark passages, secrets, tokens.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame that is written and read
again as the next one's docs. All but the last return the columns of ``documents``. ``run`` applies them to the table.

Rows are told apart by more than their id, so a null id or an id with several texts costs no row that a stage does not
reject; repeated rows are copies, of which near-duplicate removal keeps one. Columns beyond those of
``documents`` pass through. Empty and null texts are clean and stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.llm.bpe import encode
from salescast.llm.decontamination import contamination
from salescast.llm.near_dedup import near_duplicates
from salescast.llm.queries import byte_ranks, remainder, table
from salescast.llm.secret_scan import redact
from salescast.llm.text import unused
from salescast.llm.toxicity import toxicity
from salescast.session import materialize

#: Documents with this probability of being toxic go.
TOXIC = 0.5
#: Documents of this similarity in a hundred are near duplicates.
SIMILAR = 80


def _row_key() -> Column:
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text").cast("string"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from labels whose crc32(doc_id) mod 5 is not 0."""
    name = unused(docs, "toxicity")
    scored = toxicity(docs, table(spark, sf_dir, "labels"), remainder(5) != 0, column=name)
    return scored.where(F.col(name) < TOXIC).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (similarity of 0.8 and more) the document with the smallest id stays, one without an id last of all."""
    name = unused(docs, "row_number")
    rows = materialize(docs.withColumn(name, F.monotonically_increasing_id()), "numbered",
                       compression="zstd")  # numbers stay once written
    groups = near_duplicates(rows.select(F.col(name).alias("doc_id"), "text"), percent=SIMILAR)
    groups = groups.select(F.col("doc_id").alias(name), "component_id")
    members = materialize(rows.select(name, "doc_id").join(groups, name), "members")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", name)
    first = members.groupBy("component_id").agg(F.min(order).alias("first")).select(F.col(f"first.{name}").alias(name))
    gone = members.select(name).join(first, name, "left_anti")
    return rows.join(gone, name, "left_anti").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    name = unused(docs, "row_key")
    keyed = docs.withColumn(name, _row_key())
    found = contamination(keyed.select(F.col(name).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    hit = found.where("contaminated").select(F.col("doc_id").alias(name)).distinct()
    return keyed.join(hit, name, "left_anti").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts give way to a mark, and n_chars follows; no document goes."""
    return redact(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents but text, and ``ids`` and their number."""
    import public_tokenizers

    return encode(docs, byte_ranks(), public_tokenizers.PATTERN).withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("byte_bpe", tokenise),
]

#: A trained classifier and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
