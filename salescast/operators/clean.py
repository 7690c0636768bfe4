"""Row filters."""

from __future__ import annotations

from pyspark.sql import DataFrame


def filter_open(df: DataFrame) -> DataFrame:
    return df.where("open = 1")


def filter_positive_sales(df: DataFrame) -> DataFrame:
    return df.where("sales > 0")


def fill_open(df: DataFrame) -> DataFrame:
    """A missing ``open`` means open."""
    return df.fillna({"open": 1}) if "open" in df.columns else df


def clean(df: DataFrame, is_train: bool = True) -> DataFrame:
    """Training: open days with sales only. Horizon: every row stays."""
    return df.transform(filter_open).transform(filter_positive_sales) if is_train else fill_open(df)
