"""Mean predictors: the baseline row of the model comparison."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.session import materialize

KEYS = ["store", "day_of_week", "promo"]


@dataclass(frozen=True)
class MeanBaseline:
    """Mean target per group and over all training rows."""

    means: DataFrame
    overall: float | None

    def predict(self, df: DataFrame, output: str = "yhat") -> DataFrame:
        """Adds the mean of the row's group, or the overall mean for an unknown group."""
        means = self.means.select(*KEYS, F.col("mean").alias("_mean"))
        fallback = F.lit(self.overall).cast("double")
        return df.join(means, KEYS, "left").withColumn(output, F.coalesce("_mean", fallback)).drop("_mean")

    def predict_overall(self, df: DataFrame, output: str = "yhat") -> DataFrame:
        return df.withColumn(output, F.lit(self.overall).cast("double"))


def fit_mean_baseline(train: DataFrame, target: str = "sales") -> MeanBaseline:
    """One scan: sums and counts per group are combined in the map tasks and reused for the overall mean."""
    groups = materialize(
        train.groupBy(*KEYS).agg(
            F.sum(target).alias("total"), F.count(target).alias("n"), F.avg(target).alias("mean")
        ),
        "means",
    )
    total, n = groups.agg(F.sum("total"), F.sum("n")).first()
    return MeanBaseline(groups, total / n if n else None)
