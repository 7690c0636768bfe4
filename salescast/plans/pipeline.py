"""The whole run: tables in, models, report and forecast out."""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.operators.enrich import duplicate_keys, enrich_store
from salescast.operators.features import available_features, feature_matrix
from salescast.operators.forecast import forecast_table
from salescast.operators.models import SalesModel
from salescast.operators.profile import cleaning_audit, dataset_summary
from salescast.operators.split import with_split
from salescast.plans.artefact import Forecaster
from salescast.plans.preprocess import Fitted, HorizonProfile, preprocess_train, profile_horizon
from salescast.plans.report import evaluation_report
from salescast.plans.train import Trained, train_all
from salescast.session import materialize, small_table
from salescast.sources import readers, schemas
from salescast.sources.writers import write_forecast, write_report

log = logging.getLogger(__name__)


@dataclass
class Result:
    """Tables and models of a run. ``audits`` has what cleaning removed, the nulls left, the split and failed models."""

    summary: DataFrame
    audits: DataFrame
    fitted: Fitted
    features: list[str]
    data: DataFrame
    trained: Trained
    report: DataFrame
    forecast: DataFrame | None = None


def training_data(
    sales: DataFrame, stores: DataFrame, validation_weeks: int | None = 6, required: list[str] | None = None
) -> tuple[DataFrame, Fitted, list[str]]:
    """Features, target and split of all usable sales rows, written once to the shared folder, a part for each side of the split.

    Every model scans this narrow table, not the raw input, and of it only its own side. Rows without a date are on neither side.
    """
    processed, fitted = preprocess_train(sales, stores, required)
    features = available_features(processed)
    split = with_split(processed, fitted.split_date(validation_weeks)).where(F.col("split").isNotNull())
    return materialize(feature_matrix(split, features, keep=("split",)), "features", by=("split",)), fitted, features


def score_horizon(
    horizon: DataFrame, stores: DataFrame, fitted: Fitted, model: SalesModel, profile: HorizonProfile | None = None
) -> DataFrame:
    """The horizon rows with ``yhat``, zero on closed days."""
    return Forecaster(fitted, model).score(horizon, stores, profile)


def audit_table(
    sales: DataFrame, stores: DataFrame, data: DataFrame, trained: Trained, cut: dt.date, horizon: HorizonProfile | None = None
) -> DataFrame:
    """(audit, item, value as text): one small table from a scan of the sales and one of the features.

    Keys found more than once in the stores multiply sales; their number and the rows that they add are audited where there are any.
    """
    counts = cleaning_audit(sales).first()
    rows = [("cleaning", k, str(v)) for k, v in counts.asDict().items()]
    missing = [f.name for f in data.schema.fields]
    sides = data.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), *(F.count_if(F.col(c).isNull()).alias(c) for c in missing if c != "split")).collect()
    left = {c: sum(r[c] for r in sides) for c in missing if c != "split"}
    rows += [("nulls", c, str(n)) for c, n in left.items() if n]
    rows += [("split", f"{r.split}_rows", str(r.rows)) for r in sides] + [("split", "split_date", str(cut))]
    doubled = duplicate_keys(sales, stores).agg(F.count(F.lit(1)).alias("keys"), F.sum("extra_rows").alias("extra_rows")).first()
    rows += [("duplicate_stores", k, str(v)) for k, v in doubled.asDict().items()] if doubled["keys"] else []
    rows += [("horizon", "rows", str(horizon.rows))] if horizon else []
    rows += [("failed_model", r.model, r.error) for r in trained.runs.where("error is not null").collect()]
    return small_table(data.sparkSession, rows, audit="string", item="string", value="string")


def forecast_sales(
    sales: DataFrame,
    stores: DataFrame,
    horizon: DataFrame | None = None,
    validation_weeks: int | None = 6,
    model_names: list[str] | None = None,
    params: dict[str, dict[str, Any]] | None = None,
    output_dir: str | None = None,
    required: list[str] | None = None,
    profile: HorizonProfile | None = None,
    strict: bool = False,
) -> Result:
    """Train and compare the models; with ``horizon``, forecast it by the best one. ``strict`` is that of ``train_all``."""
    data, fitted, features = training_data(sales, stores, validation_weeks, required)
    if horizon is not None and profile is None:
        profile = profile_horizon(horizon, stores)
    trained = train_all(data, model_names, params, features, output_dir, strict)
    report = evaluation_report(trained.scores, trained.importances)
    forecast = None
    if horizon is not None and trained.best_fitted is not None:
        forecast = forecast_table(score_horizon(horizon, stores, fitted, trained.best_fitted, profile))
    summary = dataset_summary(enrich_store(sales, stores), "Merged Training Data")
    audits = audit_table(sales, stores, data, trained, fitted.split_date(validation_weeks), profile)
    return Result(summary, audits, fitted, features, data, trained, report, forecast)


def _horizon_or_none(spark: SparkSession, data_dir: str) -> DataFrame | None:
    """The rows to forecast; without the file the run goes on and only the forecast is left out."""
    try:
        horizon = readers.read_horizon(spark, f"{data_dir}/{readers.HORIZON_FILE}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no forecast: %s", error)
        return None
    return horizon


def run_pipeline(
    spark: SparkSession,
    data_dir: str = "data",
    validation_weeks: int | None = 6,
    generate_forecast: bool = False,
    output_dir: str = "output",
    model_names: list[str] | None = None,
    params: dict[str, dict[str, Any]] | None = None,
) -> Result:
    """Run on a folder of CSV files and write models, report, forecast and the best model's forecaster below ``output_dir``."""
    sales = readers.read_sales(spark, f"{data_dir}/{readers.SALES_FILE}")
    stores = readers.read_store(spark, f"{data_dir}/{readers.STORE_FILE}")
    horizon = _horizon_or_none(spark, data_dir) if generate_forecast else None
    profile = None if horizon is None else profile_horizon(horizon, stores, schemas.REQUIRED_HORIZON)
    result = forecast_sales(
        sales, stores, horizon, validation_weeks, model_names, params, output_dir, schemas.REQUIRED_SALES, profile
    )
    write_report(result.report, f"{output_dir}/evaluation_report")
    write_report(result.audits, f"{output_dir}/audits")
    write_report(result.summary, f"{output_dir}/summary")
    if result.trained.best_fitted is not None:
        Forecaster(result.fitted, result.trained.best_fitted).save(f"{output_dir}/forecaster")
    if result.forecast is not None:
        write_forecast(result.forecast, f"{output_dir}/forecast", expected_rows=profile.rows)
    return result
