"""Train / validation split by date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN, VALIDATION = "train", "validation"


def cut_date(
    first: dt.date, last: dt.date, validation_weeks: int | None = 6, train_ratio: float = 0.8
) -> dt.date:
    """The first validation date: N weeks before the last date, or at a share of the days."""
    if validation_weeks is not None:
        return last - dt.timedelta(weeks=validation_weeks)
    return first + dt.timedelta(days=int((last - first).days * train_ratio))


def split_date(
    df: DataFrame, date: str = "sale_date", validation_weeks: int | None = 6, train_ratio: float = 0.8
) -> dt.date:
    """The cut of ``df``, as a literal that later filters can push into their scans."""
    day = F.to_date(date)
    first, last = df.agg(F.min(day), F.max(day)).first()
    if last is None:
        raise ValueError("no dates to split by")
    return cut_date(first, last, validation_weeks, train_ratio)


def with_split(df: DataFrame, cut: dt.date, date: str = "sale_date") -> DataFrame:
    """Adds ``split``; null where the date is missing."""
    day = F.to_date(date)
    return df.withColumn("split", F.when(day < F.lit(cut), TRAIN).when(day >= F.lit(cut), VALIDATION))


def time_split(
    df: DataFrame, date: str = "sale_date", train_ratio: float = 0.8, validation_weeks: int | None = 6
) -> tuple[DataFrame, DataFrame]:
    """(train, validation): dates before the cut, and from the cut on."""
    cut = F.lit(split_date(df, date, validation_weeks, train_ratio))
    day = F.to_date(date)
    return df.where(day < cut), df.where(day >= cut)


def sort_by_date(df: DataFrame, date: str = "sale_date") -> DataFrame:
    """Ascending by date. Ties have no order, and the random second key lets one busy date span many tasks."""
    return df.orderBy(F.col(date), F.rand(0))
