"""Sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from salescast.session import materialize


def write_forecast(forecast: DataFrame, path: str, expected_rows: int | None = None) -> int:
    """Write (Id, Sales) as CSV part files with a header; returns the number of rows written.

    The rows are computed once and counted before an earlier forecast at ``path`` gives way.
    """
    rows = Observation()
    out = forecast.select(F.col("id").alias("Id"), F.col("sales").alias("Sales"))
    out = materialize(out.observe(rows, F.count(F.lit(1)).alias("rows")), "forecast")
    found = rows.get["rows"]
    if expected_rows is not None and found != expected_rows:
        raise ValueError(f"{found} forecast rows for {expected_rows} horizon rows")
    out.write.mode("overwrite").option("header", True).csv(path)
    return found


def write_report(report: DataFrame, path: str) -> None:
    """Write the long evaluation report as CSV."""
    report.write.mode("overwrite").option("header", True).csv(path)
