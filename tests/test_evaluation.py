import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salescast.operators import baseline, diagnostics, evaluate, forecast, importance
from salescast.plans import report

quick = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
PAIRS = "y double, yhat double"


def score(spark, pairs):
    return evaluate.metrics(spark.createDataFrame(pairs, PAIRS), by=()).first()


def test_metrics_by_hand(spark):
    row = score(spark, [(100.0, 110.0), (200.0, 180.0), (0.0, 999.0)])
    assert row.rmspe == pytest.approx(0.1)
    assert row.rmse == pytest.approx(math.sqrt(250))
    assert row.mae == pytest.approx(15)
    assert row.mape == pytest.approx(10)
    assert row.r2 == pytest.approx(1 - 500 / 5000)
    assert row.bias == pytest.approx(-5)


@pytest.mark.parametrize("pairs", [[], [(0.0, 5.0)], [(-1.0, 5.0)]])
def test_no_positive_target(spark, pairs):
    assert tuple(score(spark, pairs)) == (0.0, None, None, None, 0.0, None)


def test_constant_target_has_r2_zero(spark):
    assert score(spark, [(5.0, 4.0), (5.0, 6.0), (5.0, 5.0)]).r2 == 0.0


def test_missing_prediction_is_rejected(spark):
    with pytest.raises(Exception, match="missing predictions"):
        score(spark, [(5.0, None), (5.0, 6.0)])


positive = st.floats(1, 1e4)


@quick
@given(st.lists(st.tuples(positive, positive), min_size=2, max_size=30), st.floats(0.1, 100))
def test_metrics_agree_with_numpy_and_scale(spark, pairs, factor):
    y, yhat = map(np.array, zip(*pairs))
    df = spark.createDataFrame(pairs, PAIRS)
    row = evaluate.metrics(df, by=()).first()
    assert row.rmspe == pytest.approx(np.sqrt(np.mean(((y - yhat) / y) ** 2)), abs=1e-9)
    assert row.bias == pytest.approx(-np.mean(y - yhat), abs=1e-6)
    assert row.bias == pytest.approx(-diagnostics.residuals(df).agg(F.avg("residual")).first()[0], abs=1e-6)
    scaled = evaluate.metrics(df.select((F.col("y") * factor).alias("y"), (F.col("yhat") * factor).alias("yhat")), by=())
    assert scaled.first().rmspe == pytest.approx(row.rmspe, rel=1e-6, abs=1e-9)


def scores(spark):
    predictions = spark.createDataFrame(
        [(m, s, 100.0 + i, (100.0 + i) * (1 + e)) for m, e in (("a", 0.2), ("b", 0.1), ("c", 0.1))
         for s in ("train", "validation") for i in range(3)],
        "model string, split string, y double, yhat double",
    )
    return evaluate.metrics(predictions), predictions


def test_comparison(spark):
    table, predictions = scores(spark)
    assert [r.model for r in evaluate.comparison_table(table).collect()] == ["b", "c", "a"]
    assert evaluate.comparison_table(table).columns == ["model", "train_rmspe", "val_rmspe"]
    wide = evaluate.comparison_table(table, ["rmspe", "nonsense"])
    assert wide.columns == ["model", "train_rmspe", "val_rmspe", "train_nonsense", "val_nonsense"]
    assert wide.first().val_nonsense is None
    assert evaluate.best_model_name(table) == "b"
    assert evaluate.best_model_name(table.limit(0)) is None
    assert [r.split for r in evaluate.evaluate_model(predictions, "a").orderBy("split").collect()] == ["train", "validation"]
    ranking = evaluate.model_ranking(table).collect()
    assert [r.model for r in ranking] == ["b", "c", "a"] and ranking[-1].val_rmspe_pct == pytest.approx(20)


def test_comparison_long_coerces_text(spark):
    table = spark.createDataFrame([("a", "0.5", "N/A")], "model string, train_rmspe string, val_rmspe string")
    assert sorted(evaluate.comparison_long(table).collect()) == [("a", "train", 0.5), ("a", "validation", None)]
    assert evaluate.comparison_long(table, "mae") is None


def test_normalized_scores(spark):
    # The published results of the four models.
    rows = [("A", 0.1489, 0.8995, 4.0), ("B", 0.2625, 0.7725, 4.5), ("C", 0.2690, 0.6943, 17.0), ("D", 0.5099, 0.2174, 0.1)]
    table = spark.createDataFrame(rows, "model string, val_rmspe double, val_r2 double, cost double")
    out = {r.model: r for r in evaluate.model_scores_normalized(table).collect()}
    assert out["D"].rmspe_score == 0 and out["C"].speed_score == 0
    assert out["A"].rmspe_score == pytest.approx(1 - 0.1489 / 0.5099)


def test_evaluator(spark):
    evaluator = evaluate.RmspeEvaluator("y", "yhat")
    assert not evaluator.isLargerBetter()
    assert evaluator.evaluate(spark.createDataFrame([(100.0, 110.0)], PAIRS)) == pytest.approx(0.1)


# The published importances of the best model, in percent.
PUBLISHED = {
    "promo": 25.30, "competition_distance": 14.11, "promo2": 13.96, "store_type": 10.97, "store": 10.50,
    "assortment": 9.79, "competition_months_open": 4.08, "day_of_week": 3.99, "state_holiday": 3.65,
    "is_month_end": 3.64, "is_weekend": 2.78, "promo2_weeks_active": 2.19, "day_of_year": 2.16,
    "is_month_start": 2.05, "day": 1.95,
}


def published(spark):
    rows = [("m", f, v) for f, v in PUBLISHED.items()] + [("other", "promo", 9.0)]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


def test_importance_share_is_of_the_top_n(spark):
    rows = importance.importance_share(published(spark), "m", 10).collect()
    assert [r.feature for r in rows] == list(PUBLISHED)[:10]
    assert sum(r.share_pct for r in rows) == pytest.approx(100)
    assert rows[0].share_of_all_pct == pytest.approx(25.30 / sum(PUBLISHED.values()) * 100)
    assert importance.top_features(published(spark), "absent").count() == 0


def test_importance_by_category(spark):
    rows = {r.category: r for r in importance.importance_by_category(published(spark), "m").collect()}
    assert rows["Promotions"].importance == pytest.approx(25.30 + 13.96 + 2.19)
    assert rows["Store"].importance == pytest.approx(10.97 + 10.50 + 9.79)
    assert rows["Competition"].importance == pytest.approx(14.11 + 4.08)
    assert rows["Time"].importance == pytest.approx(3.99 + 3.65 + 3.64 + 2.78 + 2.16 + 2.05 + 1.95)
    assert sum(r.share_pct for r in rows.values()) == pytest.approx(100)


def test_report(spark):
    table, predictions = scores(spark)
    importances = spark.createDataFrame([("b", "promo", 3.0), ("b", "store", 1.0)], published(spark).schema)
    rows = report.evaluation_report(table, importances).collect()
    assert [r.metric for r in rows if r.section == "best_model"] == ["rmspe", "rmse", "mae", "mape", "r2", "bias"]
    assert {r.item for r in rows if r.section == "best_model"} == {"b"}
    assert {(r.item, r["rank"]) for r in rows if r.section == "comparison"} == {("b", 1), ("c", 2), ("a", 3)}
    assert [(r.item, r.value) for r in rows if r.section == "importance"] == [("promo", 75.0), ("store", 25.0)]
    assert report.evaluation_report(table.limit(0), importances).collect() == []
    tables = report.diagnostics(table, importances, predictions)
    assert tables["residuals"].count() == 3 and tables["predictions_vs_actual"].count() == 3
    assert tables["residual_histogram"].agg(F.sum("count")).first()[0] == 3
    assert tables["model_comparison"].count() == 6 and tables["feature_importance"].count() == 2
    assert report.diagnostics(table.limit(0), importances, predictions) == {}


# Histograms


def counts(spark, values, bins=50):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return diagnostics.histogram(df, "x", bins).orderBy("bin").collect()


def test_histogram_edges(spark):
    rows = counts(spark, [0.0, 10.0, 10.0], 5)
    assert [r["count"] for r in rows] == [1, 0, 0, 0, 2]
    assert (rows[0].low, rows[-1].high) == (0.0, 10.0)


def test_histogram_of_one_value(spark):
    rows = counts(spark, [3.0, 3.0])
    assert (rows[0].low, rows[-1].high) == (2.5, 3.5)
    assert [r["count"] for r in rows] == list(np.histogram([3.0, 3.0], 50)[0])


def test_histogram_without_values(spark):
    assert counts(spark, [None]) == []


@quick
@given(st.lists(st.floats(-1e6, 1e6).map(lambda v: round(v, 3)), min_size=1, max_size=60))
def test_histogram_agrees_with_numpy(spark, values):
    assert [r["count"] for r in counts(spark, values)] == list(np.histogram(values, 50)[0])


def test_sales_histogram_has_a_range_per_side(spark):
    train = spark.createDataFrame([(1,), (5,)], "sales int")
    validation = spark.createDataFrame([(100,), (200,), (150,)], "sales int")
    rows = diagnostics.sales_histogram(train, validation).groupBy("split").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("count").alias("n")).collect()
    assert {r.split: (r.low, r.high, r.n) for r in rows} == {"train": (1, 5, 2), "validation": (100, 200, 3)}
    assert diagnostics.sales_histogram(train).count() == 50


# Samples


def test_sample_has_the_exact_size_and_no_repeats(spark):
    df = spark.range(20000).selectExpr("cast(id as double) y", "cast(id as double) yhat")
    sample = diagnostics.prediction_sample(df, 5000)
    assert sample.count() == 5000 and sample.distinct().count() == 5000
    assert diagnostics.prediction_sample(df.limit(30), 5000).count() == 30
    bounds = diagnostics.sample_bounds(spark.createDataFrame([(1.0, 9.0), (4.0, -2.0)], PAIRS)).first()
    assert tuple(bounds) == (-2.0, 9.0)


# Baseline and forecast


def test_mean_baseline(spark):
    schema = "store int, day_of_week int, promo int, sales int"
    train = spark.createDataFrame([(1, 1, 0, 10), (1, 1, 0, 20), (2, 1, 0, 60)], schema)
    model = baseline.fit_mean_baseline(train)
    rows = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (2, 1, 1)], "store int, day_of_week int, promo int")
    assert [r.yhat for r in model.predict(rows).orderBy("store", "promo").collect()] == [15.0, 60.0, 30.0]
    assert {r.yhat for r in model.predict_overall(rows).collect()} == {30.0}
    assert baseline.fit_mean_baseline(train.limit(0)).overall is None


def test_forecast(spark):
    df = spark.createDataFrame([(1, 0.0, 50.0), (2, 1.0, 50.0), (3, 1.0, -4.0), (4, 1.0, None)],
                               "id bigint, open double, yhat double")
    assert forecast.forecast_table(forecast.zero_closed(df)).collect() == [(1, 0.0), (2, 50.0), (3, 0.0), (4, None)]
    assert forecast.zero_closed(df.drop("open")).first().yhat == 50.0


def test_nan_predictions_fail_the_metrics(spark):
    df = spark.createDataFrame([("m", "train", 1.0, float("nan")), ("m", "train", 2.0, 2.0)],
                               "model string, split string, y double, yhat double")
    with pytest.raises(Exception, match="missing predictions"):
        evaluate.metrics(df).collect()
