"""A deterministic importance table for the importance reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.session import gathered
from salescast.sources.schemas import FEATURES


def importance_input(data: DataFrame) -> DataFrame:
    """(model, feature, importance): |slope| of the one-feature line through the sales rows.

    All lines are fitted in one aggregation. A feature without variation gets 0.
    """
    slopes = data.agg(
        *[F.coalesce(F.abs(F.regr_slope(F.col("sales"), F.col(f))), F.lit(0.0)).alias(f) for f in FEATURES]
    )
    rows = slopes.unpivot([], FEATURES, "feature", "importance").select(F.lit("line").alias("model"), "*")
    return gathered(rows)
