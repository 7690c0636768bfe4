"""Feature derivation and projection."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.functions import stores
from salescast.functions.calendar import calendar_features
from salescast.sources.schemas import FEATURES, TARGET

log = logging.getLogger(__name__)


def normalize_date(df: DataFrame, date: str = "sale_date") -> DataFrame:
    return df.withColumn(date, F.to_date(date))


def add_date_features(df: DataFrame, date: str = "sale_date") -> DataFrame:
    """Adds year, month, day, week_of_year, day_of_year and the weekend / month start / month end flags."""
    return normalize_date(df, date).withColumns(calendar_features(date))


def add_competition_features(df: DataFrame) -> DataFrame:
    """Adds competition_months_open and has_competition; needs the date features."""
    return df.withColumns(
        {"competition_months_open": stores.competition_months_open(), "has_competition": stores.has_competition()}
    )


def add_promo_features(df: DataFrame) -> DataFrame:
    """Adds promo2_weeks_active and is_promo2_month; needs the date features."""
    return df.withColumns(
        {"promo2_weeks_active": stores.promo2_weeks_active(), "is_promo2_month": stores.is_promo2_month()}
    )


def available_features(df: DataFrame, features: list[str] = FEATURES) -> list[str]:
    """The features that ``df`` has, in order; the others are reported and left out."""
    absent = [c for c in features if c not in df.columns]
    if absent:
        log.warning("missing features: %s", absent)
    return [c for c in features if c in df.columns]


def feature_matrix(
    df: DataFrame, features: list[str] = FEATURES, target: str = TARGET, keep: tuple[str, ...] = ()
) -> DataFrame:
    """The model inputs, the target if there is one, and the columns to keep along."""
    columns = available_features(df, features) + [c for c in (target, *keep) if c in df.columns]
    return df.select(*dict.fromkeys(columns))
