"""Label encoding of text categories."""

from __future__ import annotations

import logging
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescast.session import materialize, small_table
from salescast.sources.schemas import CATEGORICAL

log = logging.getLogger(__name__)

MISSING = "nan"
UNSEEN = -1

# Copies of a mapping that a hot label is spread over if the mapping is too large to be broadcast.
SALT = 16


@dataclass(frozen=True)
class LabelMap:
    """Fitted codes: ``table`` has (column, label, code) for each of ``columns``."""

    columns: tuple[str, ...]
    table: DataFrame


def as_label(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(MISSING))


def _distinct_labels(df: DataFrame, columns: list[str]) -> DataFrame:
    # Combinations first: what leaves a map task is a handful of rows, however large the table.
    combinations = df.select(*[as_label(c).alias(c) for c in columns]).distinct()
    return combinations.unpivot([], columns, "column", "label").distinct()


def _number(labels: DataFrame) -> DataFrame:
    """Rank within each column from a global sort: position in the run plus the size of the earlier runs.

    A run is the part of a column that one sort task holds, so there are few of them.
    """
    placed = labels.orderBy("column", "label").withColumn("position", F.monotonically_increasing_id())
    placed = materialize(placed, "labels").withColumn("run", F.shiftright("position", 33))
    earlier = Window.partitionBy("column").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        placed.groupBy("column", "run")
        .agg(F.count(F.lit(1)).alias("size"), F.min("position").alias("start"))
        .withColumn("before", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    )
    code = F.col("before") + F.col("position") - F.col("start")
    return materialize(
        placed.join(runs, ["column", "run"]).select("column", "label", code.cast("int").alias("code")), "codes"
    )


def fit_labels(df: DataFrame, columns: list[str] = CATEGORICAL) -> LabelMap:
    """Codes 0..k-1 for the sorted distinct labels of each column; missing values are the label ``nan``."""
    present = [c for c in columns if c in df.columns]
    if not present:
        return LabelMap((), small_table(df.sparkSession, [], column="string", label="string", code="int"))
    return LabelMap(tuple(present), _number(_distinct_labels(df, present)))


def encode_labels(df: DataFrame, labels: LabelMap, columns: list[str] = CATEGORICAL) -> DataFrame:
    """Replaces values by their codes; unseen values become -1, columns without codes stay text.

    The mapping has a row per label and salt, each once, so Catalyst drops the join of a column that is not used, and a
    common label is dealt out where the mapping is too large for a broadcast.
    """
    # Any even spread will do; hashing more columns would keep them all in the plan.
    spread = [c for c in ("store", "sale_date") if c in df.columns] or df.columns
    df = df.withColumn("_row_salt", F.pmod(F.xxhash64(*spread), F.lit(SALT)))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long")))
    for column in columns:
        if column not in df.columns:
            continue
        if column not in labels.columns:
            log.warning("no codes for %s, left as text", column)
            continue
        codes = labels.table.where(F.col("column") == column).select(
            F.col("label").alias("_label"), F.col("code"), salts.alias("_salt")
        ).groupBy("_label", "_salt").agg(F.max("code").alias("_code"))
        joined = df.join(codes, (as_label(column) == F.col("_label")) & (F.col("_row_salt") == F.col("_salt")), "left")
        df = joined.withColumn(column, F.coalesce("_code", F.lit(UNSEEN))).drop("_label", "_salt", "_code")
    return df.drop("_row_salt")
