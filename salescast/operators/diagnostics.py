"""The tables behind the diagnostic charts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescast.operators.split import TRAIN, VALIDATION
from salescast.session import small_table


def residuals(df: DataFrame, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """Adds ``residual`` = y - yhat; positive means forecast too low, the opposite sign of the bias."""
    return df.withColumn("residual", F.col(y) - F.col(yhat))


def _bin(value: Column, low: float, high: float, bins: int) -> Column:
    """Bin number; estimated from the width, then set right against the edges themselves."""
    width = (high - low) / bins
    guess = F.least(F.floor((value - low) / (high - low) * bins), F.lit(bins - 1)).cast("int")
    return (
        F.when(value < guess * width + low, guess - 1)
        .when((guess < bins - 1) & (value >= (guess + 1) * width + low), guess + 1)
        .otherwise(guess)
    )


def _edges(spark, low: float, high: float, bins: int) -> DataFrame:
    width = (high - low) / bins
    return spark.range(bins).select(
        F.col("id").cast("int").alias("bin"), (F.col("id") * width + low).alias("low"),
        F.when(F.col("id") == bins - 1, high).otherwise((F.col("id") + 1) * width + low).alias("high"))


def histograms(df: DataFrame, column: str, by: str, bins: int = 50) -> DataFrame:
    """(bin, low, high, count, ``by``): a histogram with a range of its own for each value of ``by``.

    Two jobs for all of them: the ranges, one row for each value of ``by``, and the counts; both are combinable aggregates, and
    nothing is written between them.
    """
    spark, value = df.sparkSession, F.col(column).cast("double")
    known = df.where(value.isNotNull() & ~F.isnan(value)).select(value.alias("value"), F.col(by).alias("by"))
    ranges = [(r["by"], *((r.low - 0.5, r.high + 0.5) if r.low == r.high else (r.low, r.high)))
              for r in known.groupBy("by").agg(F.min("value").alias("low"), F.max("value").alias("high")).collect()]
    if not ranges:
        return small_table(spark, [], bin="int", low="double", high="double", count="bigint", **{by: "string"})
    place = F.coalesce(*(F.when(F.col("by").eqNullSafe(F.lit(key)), _bin(F.col("value"), low, high, bins)) for key, low, high in ranges))
    counts = known.groupBy(F.col("by").alias("of"), place.alias("place")).agg(F.count(F.lit(1)).alias("count"))
    edges = reduce(DataFrame.unionByName, (_edges(spark, low, high, bins).withColumn(by, F.lit(key)) for key, low, high in ranges))
    found = edges.join(counts, (F.col("bin") == F.col("place")) & F.col(by).eqNullSafe(F.col("of")), "left")
    return found.select("bin", "low", "high", F.coalesce("count", F.lit(0).cast("long")).alias("count"), by)


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """(bin, low, high, count) of equal-width bins over the value range, the last one closed; empty bins stay.

    A single value is given a range of one around it. Without values the result is empty.
    """
    return histograms(df.withColumn("_all", F.lit("")), column, "_all", bins).drop("_all")


def sales_histogram(train: DataFrame, validation: DataFrame | None = None, bins: int = 50) -> DataFrame:
    """Histograms of sales per split, each over its own range."""
    sides = {TRAIN: train} if validation is None else {TRAIN: train, VALIDATION: validation}
    rows = reduce(DataFrame.unionByName, (df.select("sales").withColumn("split", F.lit(side)) for side, df in sides.items()))
    return histograms(rows, "sales", "split", bins)


def prediction_sample(df: DataFrame, size: int = 5000, seed: int = 42) -> DataFrame:
    """Exactly ``size`` rows without replacement, or all rows if there are no more than that.

    Rows with the smallest random keys are taken: each task keeps its own ``size`` smallest, one merges them.
    """
    return df.withColumn("_key", F.rand(seed)).orderBy("_key").limit(size).drop("_key")


def sample_bounds(sample: DataFrame, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """(low, high) over both columns: the ends of the perfect-prediction line."""
    return sample.agg(F.min(F.least(y, yhat)).alias("low"), F.max(F.greatest(y, yhat)).alias("high"))
