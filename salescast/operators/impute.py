"""Imputation of store attributes."""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.session import materialize

SINCE_COLUMNS = [
    "competition_open_since_month", "competition_open_since_year", "promo2_since_week", "promo2_since_year",
]

# Ranges that a histogram is cut into at a time; it is read once it has no more values than that.
PIECES = 256


def _around(histogram: DataFrame, low: int, high: int, pieces: int) -> tuple[DataFrame, int]:
    """The slice of ``histogram`` that holds the ranks ``low`` and ``high``, and the weight before it."""
    cuts = sorted(set(histogram.approxQuantile("value", [i / pieces for i in range(1, pieces)], 0.1 / pieces)))
    piece = sum(((F.col("value") > cut).cast("int") for cut in cuts), F.lit(0))
    weights = dict(histogram.groupBy(piece.alias("piece")).agg(F.sum("n")).collect())
    running = list(accumulate(weights.get(i, 0) for i in range(len(cuts) + 1)))
    first, last = bisect_right(running, low), bisect_right(running, high)
    inside = F.lit(True)
    if first > 0:
        inside = inside & (F.col("value") > cuts[first - 1])
    if last < len(cuts):
        inside = inside & (F.col("value") <= cuts[last])
    return histogram.where(inside), running[first - 1] if first else 0


def exact_median(df: DataFrame, column: str, weight: str | None = None) -> float | None:
    """Exact median of the non-missing values; the middle two are averaged for an even count.

    Rows are first reduced to (value, count), so only distinct values are shuffled. If there are many of
    them, the ranks around the middle are cut out by value range, as often as needed.
    """
    count = F.sum(weight) if weight else F.count(F.lit(1))
    histogram = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("double").alias("value"))
        .agg(count.cast("bigint").alias("n"))
    )
    histogram = materialize(histogram, "median")
    size, total = histogram.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not size:
        return None
    low, high = (total - 1) // 2, total // 2
    while size > PIECES:
        histogram, before = _around(histogram, low, high, PIECES)
        low, high, size = low - before, high - before, histogram.count()
    rows = sorted(histogram.collect())
    upto = list(accumulate(n for _, n in rows))
    return (rows[bisect_right(upto, low)].value + rows[bisect_right(upto, high)].value) / 2


def impute_distance(df: DataFrame, fill: float | None = None) -> DataFrame:
    """Missing competition distances become ``fill``, or the median over the rows of ``df`` itself."""
    if "competition_distance" not in df.columns:
        return df
    value = exact_median(df, "competition_distance") if fill is None else fill
    return df if value is None else df.fillna({"competition_distance": float(value)})


def impute_since(df: DataFrame) -> DataFrame:
    """Unknown start of competition or promotion becomes 0."""
    present = [c for c in SINCE_COLUMNS if c in df.columns]
    return df.fillna(0, present) if present else df


def impute_interval(df: DataFrame) -> DataFrame:
    """No promotion interval becomes the empty string."""
    return df.fillna("", ["promo_interval"]) if "promo_interval" in df.columns else df


def impute(df: DataFrame, distance_fill: float | None = None) -> DataFrame:
    return impute_interval(impute_since(impute_distance(df, distance_fill)))
