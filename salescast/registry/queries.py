"""One query per operator, over the tables derived from a scale-factor folder.

Every query takes (spark, sf_dir) and reads the whole tables. Float results are rounded for comparison.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.functions.calendar import calendar_features
from salescast.functions.errors import METRICS, error_measures
from salescast.operators import clean, diagnostics, encode, evaluate, features, forecast, importance, impute, profile
from salescast.operators import split as splits
from salescast.operators.baseline import fit_mean_baseline
from salescast.operators.enrich import duplicate_keys, enrich_store
from salescast.operators.models import SalesModel, available_models, create_model
from salescast.plans.artefact import Forecaster, load_forecaster
from salescast.plans.pipeline import forecast_sales, score_horizon, training_data
from salescast.plans.preprocess import preprocess_horizon, preprocess_train
from salescast.plans.report import evaluation_report
from salescast.plans.train import Trained, train_all
from salescast.plans.tune import time_folds, tune
from salescast.registry.inputs import importance_input
from salescast.session import gathered, materialize, scratch_path, small_table
from salescast.sources import derived, readers, schemas, writers

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Inputs of the linear model whose fit the SQL check can reproduce in closed form.
LINEAR_FEATURES = ["promo", "day_of_week", "promo2"]


def query(function: Query) -> Query:
    """Register under the function's name; ``_query`` is dropped where it only avoids a clash with an import."""
    QUERIES[function.__name__.removesuffix("_query")] = function
    return function


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(c, digits) for c in floats}) if floats else df


# Inputs ---------------------------------------------------------------------------------------------------


def sales(spark, sf):
    return derived.sales_table(spark, sf)


def stored_sales(spark, sf):
    """The sales table as a file, for queries that scan it more than once."""
    return materialize(derived.sales_table(spark, sf), "sales")


def horizon(spark, sf):
    return derived.horizon_table(spark, sf)


def stores(spark, sf):
    return derived.store_table(spark, sf)


def enriched(spark, sf):
    return enrich_store(sales(spark, sf), stores(spark, sf))


def enriched_open(spark, sf):
    return clean.clean(enriched(spark, sf))


def dated(spark, sf):
    return features.add_date_features(enriched_open(spark, sf))


def keyed(df: DataFrame, *columns: str) -> DataFrame:
    return df.select("store", "sale_date", *columns)


def with_side(df: DataFrame) -> DataFrame:
    return splits.with_split(df, splits.split_date(df))


def baseline_wide(spark, sf):
    """Both sides with the predictions of the two mean predictors."""
    data = with_side(clean.clean(stored_sales(spark, sf)))
    model = fit_mean_baseline(data.where(F.col("split") == splits.TRAIN))
    return model.predict_overall(model.predict(data, "by_group"), "by_mean")


def baseline_predictions(spark, sf):
    return evaluate.stack_predictions(baseline_wide(spark, sf), {"mean_baseline": "by_group", "global_mean": "by_mean"})


def baseline_scores(spark, sf):
    return evaluate.metrics(baseline_predictions(spark, sf))


def linear_fit(data: DataFrame) -> SalesModel:
    model = create_model("linear_regression")
    return model.fit(data.where(F.col("split") == splits.TRAIN), LINEAR_FEATURES)


def feature_data(spark, sf):
    return training_data(stored_sales(spark, sf), stores(spark, sf))[0]


def trained_models(spark, sf, *names: str) -> tuple[DataFrame, dict[str, Trained]]:
    """The features, and the named models at their documented sizes, each fitted once per session and folder. A failed fit raises."""
    key = spark.sparkContext.applicationId, sf
    if key not in _TRAINED:
        data, fitted, inputs = training_data(stored_sales(spark, sf), stores(spark, sf))
        _TRAINED[key] = data, inputs, {}
    data, inputs, known = _TRAINED[key]
    for name in names:
        if name not in known:
            known[name] = train_all(data, [name], features=inputs, strict=True)
    return data, {name: known[name] for name in names}


_TRAINED: dict[tuple[str, str], tuple[DataFrame, list[str], dict[str, Trained]]] = {}


def fit_facts(spark, sf, *names: str) -> DataFrame:
    """Of each fitted model and side: rows scored, whether all predictions are sane, whether it beats the mean."""
    data, trained = trained_models(spark, sf, *names)
    out = None
    for own in trained.values():
        top = data.where(F.col("split") == splits.TRAIN).agg(F.max("sales").alias("top"), F.avg("sales").alias("mean"))
        rows = own.predictions.join(F.broadcast(top))
        beats = error_measures("y", "yhat")["rmspe"] < error_measures("y", "mean")["rmspe"]
        # Means of leaves stay within the targets; a sum of trees may go beyond, but not far.
        most = 1.0 if "RandomForest" in own.models else 2.0
        facts = rows.groupBy("model", "split").agg(
            F.count(F.lit(1)).alias("rows"), F.bool_and(F.col("yhat").between(0, F.col("top") * most + 1e-6)).alias("in_range"),
            beats.alias("beats_mean"))
        out = facts if out is None else out.unionByName(facts)
    return out


def three_models_scores(data: DataFrame, line: SalesModel | None = None) -> DataFrame:
    """Scores of the two mean predictors and the three-feature linear model, fitted here unless given, on both sides."""
    means = fit_mean_baseline(data.where(F.col("split") == splits.TRAIN))
    wide = (line or linear_fit(data)).predict(means.predict_overall(means.predict(data, "by_group"), "by_mean"), "by_line")
    columns = {"mean_baseline": "by_group", "global_mean": "by_mean", "LinearRegression": "by_line"}
    return gathered(evaluate.metrics(evaluate.stack_predictions(wide, columns)))


def validation_residuals(spark, sf):
    data = baseline_wide(spark, sf).where(F.col("split") == splits.VALIDATION)
    return diagnostics.residuals(data, "sales", "by_group")


# Sources and sinks ----------------------------------------------------------------------------------------


def _through_csv(spark: SparkSession, table: DataFrame, read) -> DataFrame:
    path = scratch_path(spark, "csv")
    table.write.option("header", True).csv(path)
    return read(spark, path)


@query
def scan_sales(spark, sf):
    return _through_csv(spark, sales(spark, sf), readers.read_sales)


@query
def scan_horizon(spark, sf):
    return _through_csv(spark, horizon(spark, sf), readers.read_horizon)


@query
def scan_store(spark, sf):
    return _through_csv(spark, stores(spark, sf), readers.read_store)


@query
def required_nulls(spark, sf):
    of_sales = readers.required_nulls(sales(spark, sf), schemas.REQUIRED_SALES).withColumn("dataset", F.lit("sales"))
    of_horizon = readers.required_nulls(horizon(spark, sf), [*schemas.REQUIRED_HORIZON, "open"])
    return of_sales.unionByName(of_horizon.withColumn("dataset", F.lit("horizon")))


@query
def forecast_sink(spark, sf):
    path = scratch_path(spark, "forecast")
    writers.write_forecast(forecast_table(spark, sf), path)
    return rounded(spark.read.schema("id bigint, sales double").option("header", True).csv(path))


# Join -----------------------------------------------------------------------------------------------------


@query
def enrich_store_query(spark, sf):
    return enriched(spark, sf).select(
        "store", "sale_date", "sales", "store_type", "assortment", "competition_distance", "promo_interval"
    )


@query
def enriched_sales(spark, sf):
    return enriched(spark, sf)


@query
def enriched_horizon(spark, sf):
    return enrich_store(horizon(spark, sf), stores(spark, sf))


# Profiles -------------------------------------------------------------------------------------------------


@query
def dataset_summary(spark, sf):
    return rounded(profile.dataset_summary(enriched(spark, sf), "sales"))


@query
def column_types(spark, sf):
    return profile.column_types(enriched(spark, sf))


@query
def remaining_nulls(spark, sf):
    return profile.remaining_nulls(impute.impute(enrich_store(horizon(spark, sf), stores(spark, sf))))


@query
def cleaning_audit(spark, sf):
    return profile.cleaning_audit(sales(spark, sf))


@query
def split_audit(spark, sf):
    data = clean.clean(stored_sales(spark, sf))
    return profile.split_audit(data, splits.split_date(data))


@query
def duplicate_keys_query(spark, sf):
    """Keys found twice or three times in the stores, and the sales rows that the join adds; every 13th store is listed again."""
    known = stores(spark, sf)
    listed = known.unionByName(known.where("store % 13 = 0")).unionByName(known.where("store % 26 = 0"))
    return duplicate_keys(sales(spark, sf), listed)


# Filters and imputation -----------------------------------------------------------------------------------


@query
def filter_open(spark, sf):
    return clean.filter_open(sales(spark, sf))


@query
def filter_positive_sales(spark, sf):
    return clean.filter_positive_sales(clean.filter_open(sales(spark, sf)))


@query
def fill_open(spark, sf):
    return clean.fill_open(horizon(spark, sf))


@query
def impute_distance(spark, sf):
    data = clean.clean(enrich_store(stored_sales(spark, sf), stores(spark, sf)))
    return keyed(impute.impute_distance(data), "competition_distance")


@query
def impute_since(spark, sf):
    return keyed(impute.impute_since(enriched_open(spark, sf)), *impute.SINCE_COLUMNS)


@query
def impute_interval(spark, sf):
    return keyed(impute.impute_interval(enriched_open(spark, sf)), "promo_interval")


# Date features --------------------------------------------------------------------------------------------


@query
def date_normalize(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_shipdate")
    return features.normalize_date(lines, "l_shipdate")


@query
def date_features(spark, sf):
    return keyed(dated(spark, sf), *calendar_features())


def _date_feature(name: str) -> Query:
    return lambda spark, sf: keyed(features.add_date_features(sales(spark, sf)), name)


for _key, _column in {
    "feat_year": "year", "feat_month": "month", "feat_day": "day", "feat_week": "week_of_year",
    "feat_doy": "day_of_year", "feat_weekend": "is_weekend", "feat_month_start": "is_month_start",
    "feat_month_end": "is_month_end",
}.items():
    QUERIES[_key] = _date_feature(_column)


# Competition and promotion features -----------------------------------------------------------------------


@query
def comp_months_open(spark, sf):
    return keyed(features.add_competition_features(dated(spark, sf)), "competition_months_open")


@query
def has_competition(spark, sf):
    return keyed(features.add_competition_features(dated(spark, sf)), "has_competition")


@query
def promo2_weeks(spark, sf):
    return keyed(features.add_promo_features(dated(spark, sf)), "promo2_weeks_active")


@query
def promo2_month(spark, sf):
    return keyed(features.add_promo_features(dated(spark, sf)), "is_promo2_month")


# Encoding, projection, split ------------------------------------------------------------------------------


@query
def label_fit(spark, sf):
    return encode.fit_labels(enriched_open(spark, sf)).table


@query
def label_fit_transform(spark, sf):
    data = clean.clean(enrich_store(stored_sales(spark, sf), stores(spark, sf)))
    return keyed(encode.encode_labels(data, encode.fit_labels(data)), *schemas.CATEGORICAL)


@query
def label_transform(spark, sf):
    labels = encode.fit_labels(enriched_open(spark, sf))
    rows = enrich_store(horizon(spark, sf), stores(spark, sf))
    return encode.encode_labels(rows, labels).select("id", *schemas.CATEGORICAL)


@query
def feature_matrix(spark, sf):
    return rounded(features.feature_matrix(preprocess_train(stored_sales(spark, sf), stores(spark, sf))[0]))


@query
def split_weeks(spark, sf):
    return keyed(with_side(clean.clean(stored_sales(spark, sf))), "sales", "split")


@query
def split_ratio(spark, sf):
    data = clean.clean(stored_sales(spark, sf))
    train, validation = splits.time_split(data, validation_weeks=None, train_ratio=0.8)
    both = train.withColumn("split", F.lit("train")).unionByName(validation.withColumn("split", F.lit("validation")))
    return keyed(both, "sales", "split")


@query
def sort_by_date(spark, sf):
    return keyed(splits.sort_by_date(clean.clean(sales(spark, sf))), "sales")


@query
def preprocess_train_query(spark, sf):
    return rounded(preprocess_train(stored_sales(spark, sf), stores(spark, sf))[0])


@query
def preprocess_horizon_query(spark, sf):
    labels = preprocess_train(stored_sales(spark, sf), stores(spark, sf))[1]
    return rounded(preprocess_horizon(horizon(spark, sf), stores(spark, sf), labels))


# Models ---------------------------------------------------------------------------------------------------


@query
def linear_model(spark, sf):
    """Terms of the three-feature linear model."""
    data = feature_data(spark, sf)
    model = linear_fit(data)
    terms = [("intercept", float(model.regressor.intercept)), *zip(LINEAR_FEATURES, model.coefficients())]
    return rounded(small_table(spark, terms, term="string", value="double"), 4)


@query
def one_split(spark, sf):
    """A single tree of one split on one feature: its leaves are the means of the two groups."""
    train = feature_data(spark, sf).where(F.col("split") == splits.TRAIN)
    tree = create_model("random_forest", {"numTrees": 1, "maxDepth": 1, "bootstrap": False}).fit(train, ["promo"])
    return rounded(tree.predict(train).select(F.col("promo").cast("int").alias("promo"), "yhat").distinct(), 4)


@query
def linear_model_all_features(spark, sf):
    _, trained = trained_models(spark, sf, "linear_regression")
    return rounded(trained["linear_regression"].scores, 4)


@query
def forest_model(spark, sf):
    return fit_facts(spark, sf, "random_forest")


@query
def boosted_deep(spark, sf):
    return fit_facts(spark, sf, "boosted_deep")


@query
def boosted_leaf(spark, sf):
    return fit_facts(spark, sf, "boosted_leaf")


@query
def predict(spark, sf):
    processed, fitted = preprocess_train(stored_sales(spark, sf), stores(spark, sf))
    data = splits.with_split(processed, fitted.split_date())
    data = materialize(data.select("store", "sale_date", "split", "sales", *LINEAR_FEATURES), "predict-input")
    return rounded(keyed(linear_fit(data).predict(data), "split", "yhat"), 3)


@query
def importance_linear(spark, sf):
    data = feature_data(spark, sf)
    return rounded(linear_fit(data).importance(spark, LINEAR_FEATURES), 4)


@query
def importance_tree(spark, sf):
    """Importances of the forest: one per feature, none negative, one in all; promotion counts."""
    _, trained = trained_models(spark, sf, "random_forest")
    return trained["random_forest"].importances.groupBy("model").agg(
        F.count(F.lit(1)).alias("features"), F.round(F.sum("importance"), 6).alias("total"),
        F.bool_and(F.col("importance") >= 0).alias("none_negative"),
        F.bool_or((F.col("feature") == "promo") & (F.col("importance") > 0.05)).alias("promo_counts"))


@query
def importance_table(spark, sf):
    data = feature_data(spark, sf)
    return rounded(linear_fit(data).importance(spark), 4)


@query
def train_all_query(spark, sf):
    """All four models: the line by its scores' rows, the trees by what must hold of them."""
    return fit_facts(spark, sf, *available_models()).select("model", "split", "rows", "beats_mean")


@query
def tune_time_folds(spark, sf):
    """The linear model on promotions with and without intercept, scored on three rolling folds of six weeks."""
    data = materialize(clean.clean(sales(spark, sf)).select("sale_date", "sales", "promo"), "tune")
    first, last = data.agg(F.min("sale_date"), F.max("sale_date")).first()
    search = tune(data, "linear_regression", [{}, {"fitIntercept": False}], time_folds(first, last), ["promo"])
    return rounded(search.scores)


@query
def saved_forecaster(spark, sf):
    """The horizon scored by a forecaster that was saved and loaded."""
    data, fitted, _ = training_data(stored_sales(spark, sf), stores(spark, sf))
    path = scratch_path(spark, "forecaster")
    Forecaster(fitted, linear_fit(data)).save(path)
    scored = load_forecaster(spark, path).score(horizon(spark, sf), stores(spark, sf))
    return rounded(scored.select("id", "open", "yhat"), 3)


@query
def mean_baseline(spark, sf):
    return rounded(keyed(baseline_wide(spark, sf), "split", F.col("by_group").alias("yhat")))


# Metrics and comparison -----------------------------------------------------------------------------------


def _metric(name: str) -> Query:
    return lambda spark, sf: rounded(baseline_scores(spark, sf).select("model", "split", name))


for _name in METRICS:
    QUERIES[f"metric_{_name}"] = _metric(_name)


@query
def metrics_all(spark, sf):
    return rounded(baseline_scores(spark, sf))


@query
def evaluate_model(spark, sf):
    return rounded(evaluate.evaluate_model(baseline_predictions(spark, sf), "mean_baseline"))


@query
def comparison_table(spark, sf):
    return rounded(evaluate.comparison_table(three_models_scores(feature_data(spark, sf)), [*evaluate.REPORT_METRICS, "unknown"]), 5)


@query
def best_model(spark, sf):
    return evaluate.best_model(three_models_scores(feature_data(spark, sf)))


@query
def importance_top_n(spark, sf):
    return rounded(importance.top_features(importance_input(feature_data(spark, sf)), "line", 20))


@query
def importance_share(spark, sf):
    return rounded(importance.importance_share(importance_input(feature_data(spark, sf)), "line", 10))


@query
def evaluation_report_query(spark, sf):
    data = feature_data(spark, sf)
    line = linear_fit(data)
    # The importances are those of the line; the report takes them if that is the best model.
    scores = gathered(three_models_scores(data, line).where("model <> 'mean_baseline'"))
    rows = [("LinearRegression", f, v) for f, v in zip(LINEAR_FEATURES, line.importance_values())]
    importances = small_table(spark, rows, model="string", feature="string", importance="double")
    return rounded(evaluation_report(scores, importances), 4)


# Forecast -------------------------------------------------------------------------------------------------


@query
def score_horizon_query(spark, sf):
    data, fitted, _ = training_data(stored_sales(spark, sf), stores(spark, sf))
    scored = score_horizon(horizon(spark, sf), stores(spark, sf), fitted, linear_fit(data))
    return rounded(scored.select("id", "open", "yhat"), 3)


def _baseline_horizon(spark, sf):
    data = with_side(clean.clean(stored_sales(spark, sf)))
    model = fit_mean_baseline(data.where(F.col("split") == splits.TRAIN))
    return forecast.zero_closed(model.predict(clean.fill_open(horizon(spark, sf))))


@query
def zero_closed(spark, sf):
    return rounded(_baseline_horizon(spark, sf).select("id", "open", "yhat"))


@query
def forecast_table(spark, sf):
    return rounded(forecast.forecast_table(_baseline_horizon(spark, sf)))


# Diagnostics ----------------------------------------------------------------------------------------------


@query
def comparison_long(spark, sf):
    table = evaluate.comparison_table(baseline_scores(spark, sf), ["rmspe"])
    text = F.when(F.col("model") == "global_mean", "N/A").otherwise(F.round("train_rmspe", 6).cast("string"))
    return rounded(evaluate.comparison_long(table.withColumn("train_rmspe", text)))


@query
def pred_sample(spark, sf):
    """A sample of 5,000 predictions: its size, whether all are among the predictions, and whether its bounds fit."""
    data = baseline_predictions(spark, sf).where("model = 'mean_baseline' and split = 'train'")
    rows = materialize(data.select("y", "yhat"), "predictions")
    sample = materialize(diagnostics.prediction_sample(rows, 5000), "sample")
    ends = rows.agg(F.min(F.least("y", "yhat")).alias("least"), F.max(F.greatest("y", "yhat")).alias("most"))
    strange = sample.join(rows.distinct(), ["y", "yhat"], "left_anti").agg(F.count(F.lit(1)).alias("strange"))
    bounds = diagnostics.sample_bounds(sample).crossJoin(ends).crossJoin(strange)
    return sample.agg(F.count(F.lit(1)).alias("rows")).crossJoin(bounds).select(
        "rows", "strange", ((F.col("low") >= F.col("least")) & (F.col("low") < F.col("high"))
                            & (F.col("high") <= F.col("most"))).alias("bounds_fit"))


@query
def residuals(spark, sf):
    return rounded(keyed(validation_residuals(spark, sf), F.col("by_group").alias("yhat"), "residual"))


@query
def residual_hist(spark, sf):
    return rounded(diagnostics.histogram(validation_residuals(spark, sf), "residual"))


@query
def sales_hist(spark, sf):
    return rounded(diagnostics.sales_histogram(*splits.time_split(clean.clean(stored_sales(spark, sf)))))


@query
def model_ranking(spark, sf):
    return rounded(evaluate.model_ranking(three_models_scores(feature_data(spark, sf))), 4)


@query
def importance_by_category(spark, sf):
    return rounded(importance.importance_by_category(importance_input(feature_data(spark, sf)), "line"))


@query
def model_scores_normalized(spark, sf):
    """Scores of the mean predictors; their training times are given, as measured ones differ from run to run."""
    cost = small_table(spark, [("mean_baseline", 4.0), ("global_mean", 1.0)], model="string", cost="double")
    table = evaluate.comparison_table(gathered(baseline_scores(spark, sf)), ["rmspe", "r2"])
    return rounded(evaluate.model_scores_normalized(table.join(cost, "model")))


@query
def training_time(spark, sf):
    """Measured times of two fits: rows, and whether seconds and rate were recorded without an error."""
    _, trained = trained_models(spark, sf, "linear_regression", "random_forest")
    runs = reduce(DataFrame.unionByName, (t.runs for t in trained.values()))
    return runs.select("model", "rows", ((F.col("seconds") > 0) & (F.abs(F.col("rows_per_second") * F.col("seconds") - F.col("rows")) < 1)
                                         & F.col("error").isNull()).alias("measured"))


# End to end -----------------------------------------------------------------------------------------------


def _run(spark, sf, names: list[str]) -> DataFrame:
    """Report of a full run, and the totals of its forecast."""
    result = forecast_sales(
        stored_sales(spark, sf), stores(spark, sf), materialize(horizon(spark, sf), "horizon"), model_names=names, strict=True
    )
    totals = result.forecast.agg(F.count(F.lit(1)).cast("double").alias("rows"), F.round(F.sum("sales"), 1).alias("sales"))
    forecasted = totals.unpivot([], ["rows", "sales"], "metric", "value").select(
        F.lit("forecast").alias("section"), F.lit(1).alias("rank"), F.lit(result.trained.best).alias("item"),
        "metric", "value",
    )
    return rounded(result.report.unionByName(forecasted), 3)


@query
def forecast_pipeline(spark, sf):
    """A run with the line and the forest: the line's scores, the audits, and the forecast's rows and closed days."""
    rows_to_come = materialize(horizon(spark, sf), "horizon")
    result = forecast_sales(stored_sales(spark, sf), stores(spark, sf), rows_to_come,
                            model_names=["linear_regression", "random_forest"], strict=True)
    line = result.report.where("section = 'comparison' and item = 'LinearRegression'").select(
        "section", "item", "metric", "value")
    wanted = result.audits.where("audit in ('cleaning', 'horizon') or item like '%_rows'").select(
        F.col("audit").alias("section"), F.lit("").alias("item"), F.col("item").alias("metric"), F.col("value").cast("double"))
    closed = rows_to_come.select("id", "open").join(result.forecast, "id").agg(
        F.count(F.lit(1)).cast("double").alias("rows"), F.count_if(F.col("open") == 0).cast("double").alias("closed"),
        F.count_if((F.col("open") == 0) & (F.col("sales") != 0)).cast("double").alias("closed_with_sales"),
        F.count_if(F.col("sales") < 0).cast("double").alias("negative"))
    totals = closed.unpivot([], closed.columns, "metric", "value").select(
        F.lit("forecast").alias("section"), F.lit("").alias("item"), "metric", "value")
    return rounded(line.unionByName(wanted).unionByName(totals), 3)


@query
def pipeline_linear(spark, sf):
    return _run(spark, sf, ["linear_regression"])
