"""Forecast error measures as aggregate expressions over the rows with a positive target."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ["rmspe", "rmse", "mae", "mape", "r2", "bias"]


def error_measures(y: str = "y", yhat: str = "yhat") -> dict[str, Column]:
    """The six measures; they share one pass. Without a positive target rmspe and r2 are 0, the others null."""
    actual = F.when(F.col(y) > 0, F.col(y).cast("double"))
    error = actual - F.col(yhat)
    relative = error / actual
    total = F.var_pop(actual) * F.count(actual)
    return {
        "rmspe": F.coalesce(F.sqrt(F.avg(relative * relative)), F.lit(0.0)),
        "rmse": F.sqrt(F.avg(error * error)),
        "mae": F.avg(F.abs(error)),
        "mape": F.avg(F.abs(relative)) * 100,
        "r2": F.when(F.var_pop(actual) > 0, 1 - F.sum(error * error) / total).otherwise(0.0),
        "bias": F.avg(-error),
    }


def no_missing_predictions(yhat: str = "yhat") -> Column:
    """Aggregate that fails the query when a prediction is missing, null or NaN; true otherwise."""
    missing = F.count_if(F.col(yhat).isNull() | F.isnan(yhat))
    return F.when(missing > 0, F.raise_error(F.lit("missing predictions"))).otherwise(F.lit(True))
