import datetime as dt
import random

import numpy as np
import pytest
from paths import TESTDATA
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from salescast.operators import models
from salescast.operators.models import SalesModel, create_model
from salescast.plans import pipeline
from salescast.plans.artefact import Forecaster, load_forecaster
from salescast.plans.preprocess import preprocess_horizon, preprocess_train
from salescast.plans.train import train_all
from salescast.registry import queries
from salescast.plans.tune import time_folds, tune
from salescast.sources import derived, readers, writers

# Sizes for tests of what surrounds the models.
SMALL = {
    "random_forest": {"numTrees": 10, "maxDepth": 6, "maxBins": 64},
    "boosted_deep": {"maxIter": 20, "maxDepth": 4, "stepSize": 0.3, "maxBins": 64},
    "boosted_leaf": {"maxIter": 20, "maxDepth": 3, "stepSize": 0.3, "maxBins": 64},
}


def table(spark, n=300):
    rng = random.Random(0)
    rows = [(rng.random() * 10, float(rng.randrange(3)), 1.0) for _ in range(n)]
    return spark.createDataFrame([(a, b, c, 3 * a - 2 * b + 5) for a, b, c in rows], "a double, b double, c double, sales double")


def test_registry():
    assert models.available_models() == ["linear_regression", "random_forest", "boosted_deep", "boosted_leaf"]
    assert create_model("RANDOM_Forest").name == "RandomForest"
    with pytest.raises(ValueError, match="linear_regression"):
        create_model("oracle")
    assert [m.kind for m in models.create_all_models()] == models.available_models()


def test_parameters_override_defaults():
    model = create_model("random_forest", {"numTrees": 3})
    assert model.params["numTrees"] == 3 and model.params["maxDepth"] == 15
    assert "numTrees" in repr(model)


def test_linear_model_is_least_squares(spark):
    df = table(spark)
    model = create_model("linear_regression").fit(df, ["a", "b", "c"])
    assert model.coefficients() == pytest.approx([3, -2, 0], abs=1e-9)
    assert model.regressor.intercept == pytest.approx(5)
    assert [tuple(r) for r in model.importance(spark).collect()] == [
        ("feature_0", pytest.approx(3)), ("feature_1", pytest.approx(2)), ("feature_2", 0.0),
    ]
    assert model.importance(spark, ["a", "b", "c"]).first().feature == "a"


def test_constant_features_predict_the_mean(spark):
    df = spark.createDataFrame([(2.0, 7.0, 1.0), (2.0, 7.0, 3.0)], "a double, b double, sales double")
    model = create_model("linear_regression").fit(df, ["a", "b"])
    assert model.coefficients() == pytest.approx([0, 0], abs=1e-9)
    assert [r.yhat for r in model.predict(df).collect()] == pytest.approx([2, 2])


def test_predictions_are_floored_and_need_a_fit(spark):
    df = table(spark)
    model = SalesModel("linear_regression")
    assert model.importance(spark).count() == 0
    with pytest.raises(ValueError, match="not fitted"):
        model.predict(df)
    model.fit(df, ["a", "b", "c"])
    low = spark.createDataFrame([(-10.0, 0.0, 1.0), (1.0, 0.0, 1.0)], "a double, b double, c double")
    assert [r.yhat for r in model.predict(low).collect()] == [0.0, pytest.approx(8)]


def test_missing_feature_value_raises(spark):
    model = create_model("linear_regression").fit(table(spark), ["a", "b"])
    bad = spark.createDataFrame([(None, 1.0)], "a double, b double")
    with pytest.raises(Exception, match="null|handleInvalid"):
        model.predict(bad).collect()


def test_tree_importance_and_persistence(spark, tmp_path):
    df = table(spark)
    model = create_model("random_forest", {"numTrees": 5, "maxDepth": 4}).fit(df, ["a", "b", "c"])
    values = model.importance_values()
    assert len(values) == 3 and sum(values) == pytest.approx(1) and values[2] == 0
    path = str(tmp_path / "deep" / "down" / "model")
    model.save(path)
    again = SalesModel("random_forest").load(path)
    assert again.is_fitted and again.features == ["a", "b", "c"] and again.importance_values() == values
    expected = [r.yhat for r in model.predict(df).orderBy("a").collect()]
    assert [r.yhat for r in again.predict(df).orderBy("a").collect()] == expected


def test_failed_models_are_recorded(spark):
    data = table(spark).withColumn("split", F.when(F.rand(1) < 0.8, "train").otherwise("validation"))
    trained = train_all(data, ["linear_regression", "nonsense"], features=["a", "b"])
    runs = {r.model: r for r in trained.runs.collect()}
    assert runs["LinearRegression"].error is None and runs["LinearRegression"].rows_per_second > 0
    assert "unknown model" in runs["nonsense"].error and runs["nonsense"].rows_per_second is None
    assert trained.best == "LinearRegression" and trained.best_fitted is trained.models["LinearRegression"]
    nothing = train_all(data, ["nonsense"], features=["a", "b"])
    assert nothing.best is None and nothing.scores.count() == 0 and nothing.importances.count() == 0


def test_preprocess_horizon_keeps_rows_and_codes(spark, sf_dir):
    sales, stores = derived.sales_table(spark, sf_dir), derived.store_table(spark, sf_dir)
    horizon = derived.horizon_table(spark, sf_dir)
    _, fitted = preprocess_train(sales, stores)
    out = preprocess_horizon(horizon, stores, fitted)
    assert out.count() == horizon.count()
    assert out.where("open is null").count() == 0
    fill = {r[0] for r in preprocess_horizon(horizon, stores, fitted, reuse_median=True)
            .where("store % 10 = 3").select("competition_distance").collect()}
    assert fill <= {fitted.distance_median}


@pytest.fixture(scope="module")
def csv_dir(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    tables = {"train.csv": derived.sales_table, "test.csv": derived.horizon_table, "store.csv": derived.store_table}
    for name, build in tables.items():
        build(spark, sf_dir).write.option("header", True).csv(str(folder / name))
    return folder


def test_run_pipeline(spark, csv_dir, tmp_path):
    result = pipeline.run_pipeline(
        spark, str(csv_dir), generate_forecast=True, output_dir=str(tmp_path),
        model_names=["linear_regression", "random_forest", "boosted_deep"], params=SMALL,
    )
    assert result.trained.best in {"RandomForest", "BoostedDeep"}
    val = {r.model: r.rmspe for r in result.trained.scores.where("split = 'validation'").collect()}
    assert val["LinearRegression"] > val["RandomForest"]
    assert result.trained.comparison().first().model == result.trained.best
    assert result.trained.top_features(n=3).count() == 3 and result.trained.top_features("absent").count() == 0
    sections = {r.section for r in result.report.select("section").distinct().collect()}
    assert sections == {"comparison", "best_model", "importance"}
    forecast = spark.read.schema("Id bigint, Sales double").option("header", True).csv(str(tmp_path / "forecast"))
    horizon = readers.read_horizon(spark, str(csv_dir / "test.csv"))
    assert forecast.count() == horizon.count() == forecast.select("Id").distinct().count()
    closed = horizon.where("open = 0").count()
    assert 0 < closed <= forecast.where("Sales = 0").count()
    assert SalesModel("random_forest").load(str(tmp_path / "random_forest_model")).is_fitted
    assert spark.read.option("header", True).csv(str(tmp_path / "evaluation_report")).count() == result.report.count()
    assert result.summary.first().rows == spark.read.option("header", True).csv(str(csv_dir / "train.csv")).count()


def test_pipeline_without_horizon_file(spark, csv_dir, tmp_path):
    import shutil

    shutil.copytree(csv_dir, tmp_path / "data", ignore=shutil.ignore_patterns("test.csv"))
    result = pipeline.run_pipeline(spark, str(tmp_path / "data"), generate_forecast=True,
                                   output_dir=str(tmp_path / "out"), model_names=["linear_regression"])
    assert result.forecast is None and result.trained.best == "LinearRegression"
    with pytest.raises(AnalysisException):
        pipeline.run_pipeline(spark, str(tmp_path / "absent"))


def test_missing_required_values_stop_the_run(spark, sf_dir):
    sales, stores = derived.sales_table(spark, sf_dir), derived.store_table(spark, sf_dir)
    bad = sales.withColumn("customers", F.when(F.col("open") == 1, F.col("customers")))
    closed = sales.where("open = 0").count()
    with pytest.raises(ValueError, match=rf"customers \({closed}\)"):
        preprocess_train(bad, stores, ["store", "customers"])
    preprocess_train(sales, stores, ["store", "customers"])


def test_linear_fit_matches_numpy(spark, sf_dir):
    data, _, inputs = pipeline.training_data(derived.sales_table(spark, sf_dir), derived.store_table(spark, sf_dir))
    train = data.where("split = 'train'")
    model = create_model("linear_regression").fit(train, inputs)
    rows = train.toPandas()
    x = rows[inputs].astype(float).to_numpy()
    slopes, *_ = np.linalg.lstsq(x - x.mean(0), rows.sales - rows.sales.mean(), rcond=None)
    assert model.coefficients() == pytest.approx(list(slopes), rel=1e-5, abs=1e-5)


def test_trees_beat_the_line(spark):
    """The published order: the planted structure is not linear, so the line comes last."""
    folder = TESTDATA / "sf0.01"
    if not folder.exists():
        pytest.skip("test data not available")
    tables = derived.sales_table(spark, str(folder)), derived.store_table(spark, str(folder))
    data, _, inputs = pipeline.training_data(*tables)
    trained = train_all(data, ["linear_regression", "random_forest", "boosted_deep"], SMALL, inputs)
    val = {r.model: r.rmspe for r in trained.scores.where("split = 'validation'").collect()}
    assert val["LinearRegression"] > val["RandomForest"] and val["LinearRegression"] > val["BoostedDeep"]


def test_split_date_is_a_date(spark, sf_dir):
    data, fitted, inputs = pipeline.training_data(derived.sales_table(spark, sf_dir), derived.store_table(spark, sf_dir))
    assert fitted.split_date() == fitted.last_date - dt.timedelta(days=42)
    assert data.columns == [*inputs, "sales", "split"]


def test_a_saved_model_of_another_kind_is_refused(spark, tmp_path):
    create_model("linear_regression").fit(table(spark, 20), ["a", "b"]).save(str(tmp_path / "line"))
    with pytest.raises(ValueError, match="random_forest"):
        create_model("random_forest").load(str(tmp_path / "line"))
    assert create_model("linear_regression").load(str(tmp_path / "line")).features == ["a", "b"]


def test_a_failing_model_is_in_the_audits(spark, sf_dir):
    sales, stores = derived.sales_table(spark, sf_dir), derived.store_table(spark, sf_dir)
    result = pipeline.forecast_sales(sales, stores, model_names=["linear_regression", "random_forest"],
                                     params={"random_forest": {"maxBins": 1}})
    failed = {r.item: r.value for r in result.audits.where("audit = 'failed_model'").collect()}
    assert list(failed) == ["RandomForest"] and failed["RandomForest"]
    assert result.trained.best == "LinearRegression"


def test_an_earlier_forecast_stays_if_rows_are_missing(spark, tmp_path):
    old = spark.createDataFrame([(1, 5.0)], "id bigint, sales double")
    assert writers.write_forecast(old, str(tmp_path / "f"), 1) == 1
    with pytest.raises(ValueError, match="2 forecast rows for 1"):
        writers.write_forecast(old.unionByName(old), str(tmp_path / "f"), 1)
    assert spark.read.csv(str(tmp_path / "f"), header=True).count() == 1


def test_a_forest_is_the_mean_of_its_groups(spark):
    df = table(spark)
    model = create_model("random_forest", {"numTrees": 11, "maxDepth": 3, "maxBins": 64}).fit(df, ["a", "b", "c"])
    trees = [tree for group in model.regressors for tree in group.trees]
    assert len(trees) == 11 and len(model.regressors) == models.FOREST_GROUPS
    row = model.assemble(df).orderBy("a").first()
    got = model.predict(df).orderBy("a").first().yhat
    assert got == pytest.approx(sum(tree.predict(row.features) for tree in trees) / 11)
    assert sum(model.importance_values()) == pytest.approx(1)


def test_boosting_in_segments_goes_on_where_it_stopped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(models, "SEGMENT_ROUNDS", 4)
    df, params = table(spark), {"maxIter": 10, "maxDepth": 3, "stepSize": 0.3, "maxBins": 64, "subsamplingRate": 1.0, "featureSubsetStrategy": "all"}
    whole = create_model("boosted_deep", params).fit(df, ["a", "b", "c"])
    assert [r.getNumTrees for r in whole.regressors] == [4, 4, 2]
    sizes, fit = [], models.GBTRegressor.fit

    def limited(self, rows):
        if len(sizes) == 2:
            raise RuntimeError("stopped")
        sizes.append(self.getMaxIter())
        return fit(self, rows)

    monkeypatch.setattr(models.GBTRegressor, "fit", limited)
    folder = str(tmp_path / "state")
    with pytest.raises(RuntimeError, match="stopped"):
        create_model("boosted_deep", params).fit(df, ["a", "b", "c"], resume=folder)
    assert sizes == [4, 4]
    monkeypatch.setattr(models.GBTRegressor, "fit", lambda self, rows: sizes.append(self.getMaxIter()) or fit(self, rows))
    again = create_model("boosted_deep", params).fit(df, ["a", "b", "c"], resume=folder)
    assert sizes == [4, 4, 2]  # only what was missing
    key = lambda m: [r.yhat for r in m.predict(df).orderBy("a").collect()]
    assert key(again) == pytest.approx(key(whole))
    assert create_model("boosted_deep", params).fit(df, ["a", "b", "c"], resume=folder).is_fitted and sizes == [4, 4, 2]
    with pytest.raises(ValueError, match="another fit"):
        create_model("boosted_deep", {**params, "maxDepth": 2}).fit(df, ["a", "b", "c"], resume=folder)
    path = str(tmp_path / "saved")
    again.save(path)
    assert key(SalesModel("boosted_deep").load(path)) == pytest.approx(key(again))


def test_later_segments_reduce_the_error(spark, monkeypatch):
    monkeypatch.setattr(models, "SEGMENT_ROUNDS", 5)
    df = table(spark)
    errors = []
    for rounds in (5, 10, 15):
        model = create_model("boosted_leaf", {"maxIter": rounds, "maxDepth": 3, "maxBins": 64}).fit(df, ["a", "b", "c"])
        errors.append(model.predict(df).agg(F.avg((F.col("sales") - F.col("yhat")) ** 2)).first()[0])
    assert errors[0] > errors[1] > errors[2]


def test_fits_at_once_keep_the_callers_properties(spark):
    context = spark.sparkContext
    context.setLocalProperty("spark.jobGroup.id", "mine")
    try:
        groups = models.at_once(spark, [lambda: context.getLocalProperty("spark.jobGroup.id")] * 3)
        pools = models.at_once(spark, [lambda: context.getLocalProperty("spark.scheduler.pool")] * 2)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert groups == ["mine"] * 3 and len(set(pools)) == 2 and models.at_once(spark, []) == []
    with pytest.raises(ZeroDivisionError):
        models.at_once(spark, [lambda: 1, lambda: 1 // 0])


def test_a_saved_forecaster_scores_alike(spark, sf_dir, tmp_path):
    sales, stores = derived.sales_table(spark, sf_dir), derived.store_table(spark, sf_dir)
    horizon = derived.horizon_table(spark, sf_dir)
    data, fitted, inputs = pipeline.training_data(sales, stores)
    for name in ("linear_regression", "random_forest"):
        model = create_model(name, SMALL.get(name)).fit(data.where("split = 'train'"), inputs)
        path = str(tmp_path / name)
        Forecaster(fitted, model).save(path)
        other = load_forecaster(spark.newSession(), path)
        assert (other.fitted.distance_median, other.fitted.first_date, other.fitted.last_date) == (
            fitted.distance_median, fitted.first_date, fitted.last_date)
        rows = lambda df: {r.id: r.yhat for r in df.select("id", "yhat").collect()}
        expected = rows(pipeline.score_horizon(horizon, stores, fitted, model))
        assert rows(other.score(horizon, stores)) == pytest.approx(expected)
    with pytest.raises(ValueError, match="no whole forecaster"):
        load_forecaster(spark, str(tmp_path / "absent"))


def test_time_folds_and_search(spark):
    first, last = dt.date(2020, 1, 1), dt.date(2020, 12, 31)
    folds = time_folds(first, last, 2, 4)
    assert [(f.cut, f.until) for f in folds] == [(dt.date(2020, 11, 5), dt.date(2020, 12, 3)), (dt.date(2020, 12, 3), None)]
    with pytest.raises(ValueError, match="more than the days"):
        time_folds(first, last, 9, 6)
    rows = [(first + dt.timedelta(days=i), float(i % 2), 1.0 + 3 * (i % 2)) for i in range(366)]
    data = spark.createDataFrame(rows, "sale_date date, x double, sales double")
    search = tune(data, "linear_regression", [{"fitIntercept": False}, {}], folds, ["x"])
    scores = {(r.parameters, r.fold): r.rmspe for r in search.scores.collect()}
    assert len(scores) == 4 and search.best == {} and scores["{}", 1] == pytest.approx(0, abs=1e-9)
    assert scores['{"fitIntercept": false}', 2] > 0.5


def test_fits_read_only_their_side(spark, sf_dir):
    data, _, _ = pipeline.training_data(derived.sales_table(spark, sf_dir), derived.store_table(spark, sf_dir))
    plan = data.where("split = 'train'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    assert data.where("split = 'train'").count() + data.where("split = 'validation'").count() == data.count()


def test_duplicate_stores_are_audited(spark, sf_dir):
    from salescast.operators.enrich import duplicate_keys

    sales, stores = derived.sales_table(spark, sf_dir), derived.store_table(spark, sf_dir)
    assert duplicate_keys(sales, stores).count() == 0
    doubled = stores.unionByName(stores.where("store = 3")).unionByName(stores.where("store = 3").withColumn("store", F.lit(None).cast("int")))
    (row,) = duplicate_keys(sales, doubled).collect()
    n = sales.where("store = 3").count()
    assert (row.store, row.copies, row.fact_rows, row.extra_rows) == (3, 2, n, n)
    result = pipeline.forecast_sales(sales, doubled, model_names=["linear_regression"])
    audits = {r.item: r.value for r in result.audits.where("audit = 'duplicate_stores'").collect()}
    assert audits == {"keys": "1", "extra_rows": str(n)}


def test_a_group_of_trees_is_one_task_until_it_has_many_rows(spark):
    """Each task shuffles the statistics of every node, for deep trees more than the rows."""
    rows = spark.range(100).repartition(8)
    assert models.dealt(rows, 440_000, models.GROUP_ROWS).rdd.getNumPartitions() == 1
    assert models.dealt(rows, 40_000, models.FIT_ROWS).rdd.getNumPartitions() == 1


def test_rows_are_scored_once_by_trees(spark):
    data = table(spark).withColumn("split", F.when(F.col("a") > 3, "validation").otherwise("train"))
    trained = train_all(data, ["random_forest"], {"random_forest": {"numTrees": 10, "maxDepth": 2, "maxBins": 16}}, ["a", "b"])
    assert "UDF" not in trained.predictions._jdf.queryExecution().toString()
    assert trained.predictions.count() == data.count()


def test_the_line_is_fitted_without_slicing_vectors(spark, monkeypatch):
    df = table(spark).withColumn("d", F.lit(1))
    whole = create_model("linear_regression").fit(df, ["a", "b"]).coefficients()
    with monkeypatch.context() as patch:
        patch.setattr(models.VectorSlicer, "transform", None)
        model = create_model("linear_regression").fit(df, ["a", "d", "b"])
    assert model.coefficients() == pytest.approx([whole[0], 0, whole[1]])
    assert model.predict(df).count() == df.count()
    with pytest.raises(Exception, match="(?i)null|nan"):  # a missing value in a constant feature, too
        create_model("linear_regression").fit(df.withColumn("d", F.when(F.col("a") > 3, 1)), ["a", "d"])


def test_the_report_fits_its_line_once(spark, sf_dir, monkeypatch):
    fits, fit = [], queries.linear_fit
    monkeypatch.setattr(queries, "linear_fit", lambda data: fits.append(1) or fit(data))
    assert queries.QUERIES["evaluation_report"](spark, sf_dir).count() and len(fits) == 1


def test_a_failed_fit_is_no_result_of_a_query(spark, sf_dir, monkeypatch):
    """A query without rows, or a forecast by the line alone, would look like a whole run."""
    monkeypatch.setattr(queries, "_TRAINED", {})
    tried = {"boosted_deep": "boosted_deep", "boosted_leaf": "boosted_leaf", "forest_model": "random_forest", "forecast_pipeline": "random_forest"}
    for name, kind in tried.items():
        with monkeypatch.context() as patch:
            patch.setitem(models.DEFAULTS, kind, {**models.DEFAULTS[kind], "maxBins": 1})
            with pytest.raises(Exception, match="maxBins"):
                queries.QUERIES[name](spark, sf_dir)
    monkeypatch.setitem(models.DEFAULTS, "boosted_deep", {**models.DEFAULTS["boosted_deep"], **SMALL["boosted_deep"], "maxIter": 2})
    assert queries.QUERIES["boosted_deep"](spark, sf_dir).count() == 2  # nothing of the failure is kept
    with pytest.raises(ValueError, match="nonsense"):
        train_all(table(spark).withColumn("split", F.lit("train")), ["linear_regression", "nonsense"], features=["a"], strict=True)
