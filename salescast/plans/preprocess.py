"""Fitting and applying the preprocessing steps."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescast.operators.clean import clean
from salescast.operators.encode import LabelMap, encode_labels, fit_labels
from salescast.operators.enrich import enrich_store
from salescast.operators.features import add_competition_features, add_date_features, add_promo_features
from salescast.operators.impute import exact_median, impute
from salescast.operators.split import cut_date
from salescast.session import materialize
from salescast.sources.readers import watch_required


@dataclass(frozen=True)
class Fitted:
    """What preprocessing learns from the training rows; all of it is small."""

    distance_median: float | None
    labels: LabelMap
    first_date: dt.date | None
    last_date: dt.date | None

    def split_date(self, validation_weeks: int | None = 6, train_ratio: float = 0.8) -> dt.date:
        if self.last_date is None:
            raise ValueError("no dates to split by")
        return cut_date(self.first_date, self.last_date, validation_weeks, train_ratio)


def fit(sales: DataFrame, stores: DataFrame, required: list[str] | None = None) -> Fitted:
    """Median distance, label codes and date range of the cleaned training rows, in one scan of the sales.

    They depend on a row only through its store, holiday kind and date, so sales are reduced to one row per
    store and holiday kind before the join; the wide fact table is neither joined nor shuffled. The same scan
    raises if one of the ``required`` columns has missing values, also in rows that cleaning removes.
    """
    watched, check = watch_required(sales, required) if required else (sales, lambda: None)
    reduced = (
        clean(watched)
        .groupBy("store", "state_holiday")
        .agg(F.count(F.lit(1)).alias("n"), F.min("sale_date").alias("first"), F.max("sale_date").alias("last"))
    )
    profile = materialize(enrich_store(reduced, stores), "profile")
    check()
    first, last = profile.agg(F.min("first"), F.max("last")).first()
    return Fitted(_median_distance(profile), fit_labels(profile), first, last)


def _median_distance(reduced: DataFrame) -> float | None:
    if "competition_distance" not in reduced.columns:
        return None
    return exact_median(reduced, "competition_distance", weight="n")


def transform(
    enriched: DataFrame, labels: LabelMap, is_train: bool = True, distance_fill: float | None = None
) -> DataFrame:
    """Clean, impute, derive, encode. Without ``distance_fill`` the median is taken over the rows at hand."""
    return (
        clean(enriched, is_train)
        .transform(impute, distance_fill)
        .transform(add_date_features)
        .transform(add_competition_features)
        .transform(add_promo_features)
        .transform(encode_labels, labels)
    )


def preprocess_train(
    sales: DataFrame, stores: DataFrame, required: list[str] | None = None
) -> tuple[DataFrame, Fitted]:
    """The training features and what was learnt from them."""
    fitted = fit(sales, stores, required)
    return transform(enrich_store(sales, stores), fitted.labels, True, fitted.distance_median), fitted


@dataclass(frozen=True)
class HorizonProfile:
    """What one scan of the rows to forecast tells: their number and their median distance."""

    rows: int
    distance_median: float | None


def profile_horizon(horizon: DataFrame, stores: DataFrame, required: list[str] | None = None) -> HorizonProfile:
    """One scan, reduced to a row per store; raises if a ``required`` column has missing values."""
    watched, check = watch_required(horizon, required) if required else (horizon, lambda: None)
    counts = materialize(watched.groupBy("store").agg(F.count(F.lit(1)).alias("n")), "horizon-profile")
    check()
    rows = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return HorizonProfile(rows, _median_distance(enrich_store(counts, stores)))


def preprocess_horizon(
    horizon: DataFrame, stores: DataFrame, fitted: Fitted, reuse_median: bool = False,
    profile: HorizonProfile | None = None,
) -> DataFrame:
    """The horizon features: every row stays, labels as fitted on training rows.

    By default missing distances get the median of the horizon's own rows (from ``profile``, if that was made before);
    ``reuse_median`` takes the training median instead.
    """
    fill = fitted.distance_median if reuse_median else None
    if fill is None:
        fill = (profile or profile_horizon(horizon, stores)).distance_median
    return transform(enrich_store(horizon, stores), fitted.labels, False, fill)
