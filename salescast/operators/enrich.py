"""The join of facts with the store dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def enrich_store(facts: DataFrame, stores: DataFrame, key: str = "store") -> DataFrame:
    """Left equi-join on the store: facts without a store stay with nulls, duplicate stores multiply facts.

    No hint is set: Catalyst broadcasts the dimension while its size statistic is under
    ``spark.sql.autoBroadcastJoinThreshold``; beyond that it is a shuffled join whose hot stores
    adaptive execution splits.
    """
    return facts.join(stores, key, "left")


def duplicate_keys(facts: DataFrame, stores: DataFrame, key: str = "store") -> DataFrame:
    """(key, copies, fact_rows, extra_rows) of keys found more than once in the dimension, and what the join adds for them.

    Both sides are counted before they meet; without duplicates the facts are not read at all, as adaptive execution drops a join
    with an empty side. A null key joins nothing.
    """
    copies = stores.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    rows = facts.groupBy(F.col(key).alias("of")).agg(F.count(F.lit(1)).alias("n"))
    counted = copies.join(rows, F.col(key) == F.col("of"), "left").withColumn("fact_rows", F.coalesce("n", F.lit(0).cast("long")))
    return counted.select(key, "copies", "fact_rows", (F.col("fact_rows") * (F.col("copies") - 1)).alias("extra_rows"))
