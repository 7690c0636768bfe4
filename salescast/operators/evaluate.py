"""Scoring of predictions and comparison of models.

Predictions are one long table (model, split, y, yhat); metrics are (model, split, rmspe, ..., bias).
"""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.functions.errors import METRICS, error_measures, no_missing_predictions
from salescast.operators.split import TRAIN, VALIDATION

REPORT_METRICS = ["rmspe", "rmse", "mape", "r2"]


def stack_predictions(df: DataFrame, models: dict[str, str], y: str = "sales") -> DataFrame:
    """(model, split, y, yhat) from one wide row per observation; ``models`` maps names to their columns."""
    wide = df.select("split", F.col(y).cast("double").alias("y"), *[F.col(c).alias(m) for m, c in models.items()])
    return wide.unpivot(["split", "y"], list(models), "model", "yhat").select("model", "split", "y", "yhat")


def metrics(
    predictions: DataFrame, by: tuple[str, ...] = ("model", "split"), y: str = "y", yhat: str = "yhat"
) -> DataFrame:
    """The six error measures per group, in one pass. A missing prediction fails the query."""
    measures = [column.alias(name) for name, column in error_measures(y, yhat).items()]
    checked = predictions.groupBy(*by).agg(*measures, no_missing_predictions(yhat).alias("_complete"))
    return checked.where("_complete").drop("_complete")


def evaluate_model(predictions: DataFrame, model: str) -> DataFrame:
    """(split, six measures) of one model on both sides."""
    return metrics(predictions.where(F.col("model") == model), by=("split",))


def comparison_table(scores: DataFrame, names: list[str] | None = None) -> DataFrame:
    """One row per model with ``train_<m>`` and ``val_<m>``; sorted only if rmspe is among the metrics.

    A metric that was not computed gives null columns.
    """
    names = names or ["rmspe"]
    columns = []
    for name in names:
        value = F.col(name) if name in scores.columns else F.lit(None).cast("double")
        for prefix, side in (("train", TRAIN), ("val", VALIDATION)):
            columns.append(F.max(F.when(F.col("split") == side, value)).alias(f"{prefix}_{name}"))
    table = scores.groupBy("model").agg(*columns)
    return table.orderBy(F.col("val_rmspe").asc_nulls_last(), "model") if "rmspe" in names else table


def best_model(scores: DataFrame) -> DataFrame:
    """One row (best_model): lowest validation rmspe, the name deciding ties; null if nothing was scored."""
    scored = scores.where((F.col("split") == VALIDATION) & F.col("rmspe").isNotNull())
    return scored.agg(F.min_by("model", F.struct("rmspe", "model")).alias("best_model"))


def best_model_name(scores: DataFrame) -> str | None:
    return best_model(scores).first()[0]


def model_ranking(scores: DataFrame) -> DataFrame:
    """Models by ascending validation rmspe, as percentages."""
    return (
        scores.where(F.col("split") == VALIDATION)
        .select("model", (F.col("rmspe") * 100).alias("val_rmspe_pct"))
        .orderBy("val_rmspe_pct", "model")
    )


def comparison_long(table: DataFrame, metric: str = "rmspe") -> DataFrame | None:
    """(model, split, score) of one metric of a comparison table; text that is no number becomes null."""
    sides = {f"train_{metric}": TRAIN, f"val_{metric}": VALIDATION}
    if any(column not in table.columns for column in sides):
        return None
    renamed = table.select("model", *[F.col(c).cast("string").alias(side) for c, side in sides.items()])
    long = renamed.unpivot(["model"], list(sides.values()), "split", "score")
    return long.withColumn("score", F.col("score").try_cast("double"))


def model_scores_normalized(results: DataFrame) -> DataFrame:
    """(model, rmspe_score, r2_score, speed_score), higher is better, from (model, val_rmspe, val_r2, cost).

    ``cost`` is the training time. The maxima are those of all models.
    """
    # One row, joined to one row per model; the input is read within one plan.
    top = results.agg(F.max("val_rmspe").alias("_rmspe"), F.max("cost").alias("_cost"))
    return results.crossJoin(top).select(
        "model",
        (1 - F.try_divide("val_rmspe", "_rmspe")).alias("rmspe_score"),
        F.col("val_r2").alias("r2_score"),
        (1 - F.try_divide("cost", "_cost")).alias("speed_score"),
    )


class RmspeEvaluator(Evaluator):
    """RMSPE for Spark ML tuners; smaller is better."""

    def __init__(self, labelCol: str = "sales", predictionCol: str = "prediction"):
        super().__init__()
        self.label_col, self.prediction_col = labelCol, predictionCol

    def _evaluate(self, dataset: DataFrame) -> float:
        return metrics(dataset, (), self.label_col, self.prediction_col).first()["rmspe"]

    def isLargerBetter(self) -> bool:
        return False


def metrics_long(scores: DataFrame, names: list[str] = METRICS) -> DataFrame:
    """(model, split, metric, value)."""
    return scores.unpivot(["model", "split"], names, "metric", "value")
