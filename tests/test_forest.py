import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from salescast.operators import forest, models
from salescast.operators.models import SalesModel, create_model

NAMES = ["a", "b", "c", "d"]


def table(spark, n=400, seed=1):
    rng = np.random.default_rng(seed)
    a, b, c = rng.integers(0, 200, n) / 8, rng.integers(0, 3, n), rng.integers(0, 40, n)
    y = 10 * a + 200 * (b == 1) * (c > 20) + rng.integers(0, 30, n)
    rows = [(float(i), int(j), int(k), 7, int(v)) for i, j, k, v in zip(a, b, c, y)]
    return spark.createDataFrame(rows, "a double, b int, c int, d int, sales int")


def predictions(model, df):
    return [r.yhat for r in model.predict(df).orderBy(*NAMES, "sales").collect()]


def test_a_tree_is_spark_mls_own(spark):
    df = table(spark)
    params = {"numTrees": 1, "maxDepth": 6, "bootstrap": False, "minInstancesPerNode": 5, "minInfoGain": 0.5}
    model = create_model("random_forest", params).fit(df, NAMES)
    rows = VectorAssembler(inputCols=NAMES, outputCol="features").transform(df)
    own = RandomForestRegressor(labelCol="sales", maxBins=256, featureSubsetStrategy="all", seed=42, **params).fit(rows)
    want = [r.prediction for r in own.transform(rows).orderBy(*NAMES, "sales").collect()]
    assert predictions(model, df) == pytest.approx(want)
    (tree,), (other,) = model.regressor.trees, own.trees
    assert (tree.depth, tree.numNodes) == (other.depth, other.numNodes) and tree.depth > 3
    assert model.importance_values() == pytest.approx(list(own.featureImportances.toArray()))
    assert [v > 0 for v in model.importance_values()] == [True, True, True, False]


def test_first_levels_by_histograms_give_the_same_trees(spark, monkeypatch):
    """However many rows a task takes, and however the rows lie."""
    df, params = table(spark, 600), {"numTrees": 12, "maxDepth": 7, "minInstancesPerNode": 3}
    whole = create_model("random_forest", params).fit(df.coalesce(1), NAMES)
    jobs, first_levels = [], forest.first_levels
    monkeypatch.setattr(forest, "first_levels", lambda *args: jobs.append(1) or first_levels(*args))
    monkeypatch.setattr(models, "GROUP_ROWS", 60)
    again = create_model("random_forest", params).fit(df.coalesce(1), NAMES)
    assert len(jobs) == 1 and predictions(again, df) == pytest.approx(predictions(whole, df))
    assert sum(r.totalNumNodes for r in again.regressors) == sum(r.totalNumNodes for r in whole.regressors)
    shallow = create_model("random_forest", {**params, "maxDepth": 1}).fit(df.coalesce(1), NAMES)
    assert [t.depth for r in shallow.regressors for t in r.trees] == [1] * 12
    flat = create_model("random_forest", params).fit(df.withColumn("sales", F.lit(3)), NAMES)
    assert [t.numNodes for r in flat.regressors for t in r.trees] == [1] * 12 and set(predictions(flat, df)) == {3.0}


def test_rows_go_down_arrays_as_down_spark_mls_trees(spark, tmp_path):
    df = table(spark)
    model = create_model("random_forest", {"numTrees": 13, "maxDepth": 9, "featureSubsetStrategy": "onethird"}).fit(df, NAMES)
    want = [r.prediction for r in model.fitted.transform(df).orderBy(*NAMES, "sales").collect()]
    assert predictions(model, df) == pytest.approx(want)
    model.save(str(tmp_path / "forest"))
    again = SalesModel("random_forest").load(str(tmp_path / "forest"))
    assert predictions(again, df) == pytest.approx(want) and again.importance_values() == pytest.approx(model.importance_values())
    plan = model.predict(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1  # once a row, for all groups
    empty = model.predict(df.where("a < 0"))
    assert empty.count() == 0


def test_bags_depend_on_the_row_only():
    ids = np.arange(200_000)
    once = forest.bag(ids, 42, 3, 1.0, True)
    assert (forest.bag(ids[5::7], 42, 3, 1.0, True) == once[5::7]).all()
    assert once.mean() == pytest.approx(1, abs=0.01) and once.var() == pytest.approx(1, abs=0.02)
    other = forest.bag(ids, 42, 4, 1.0, True)
    assert abs(np.corrcoef(once, other)[0, 1]) < 0.01
    assert forest.bag(ids, 42, 3, 0.3, True).mean() == pytest.approx(0.3, abs=0.01)
    assert forest.bag(ids, 42, 3, 1.0, False).min() == 1 and forest.bag(ids, 42, 3, 0.5, False).mean() == pytest.approx(0.5, abs=0.01)


def test_candidates_lie_between_all_values_or_at_quantiles(spark):
    df = spark.range(1000).select(F.array((F.col("id") % 3).cast("double"), F.lit(1.0), F.col("id").cast("double")).alias("x"))
    few, one, many = forest.candidates(df, 3, 32)
    assert list(few) == [0.5, 1.5] and len(one) == 0 and len(many) == 31
    assert np.diff([0, *many, 1000]) == pytest.approx(1000 / 32, abs=1000 / 32)


@pytest.mark.parametrize("strategy, trees, most", [
    ("all", 5, 21), ("auto", 1, 21), ("auto", 5, 7), ("sqrt", 5, 5), ("log2", 5, 5), ("onethird", 5, 7), ("0.8", 5, 17), ("3", 5, 3), ("99", 5, 21)])
def test_features_of_a_node(strategy, trees, most):
    assert forest.features_of_a_node(strategy, 21, trees) == most


def test_what_a_forest_cannot_be_fitted_on(spark):
    df = table(spark, 50)
    with pytest.raises(Exception, match="target of a row is missing"):
        create_model("random_forest", {"numTrees": 2}).fit(df.withColumn("sales", F.when(F.col("b") > 0, F.col("sales"))), NAMES)
    with pytest.raises(Exception, match="(?i)null|handleInvalid"):
        create_model("random_forest", {"numTrees": 2}).fit(df.withColumn("b", F.when(F.col("b") > 0, F.col("b"))), NAMES)
    with pytest.raises(ValueError, match="no rows"):
        create_model("random_forest", {"numTrees": 2}).fit(df.where("a < 0"), NAMES)
    weighted = create_model("random_forest", {"numTrees": 2, "maxDepth": 3, "minWeightFractionPerNode": 0.2}).fit(df, NAMES)
    assert len(predictions(weighted, df)) == 50  # by Spark ML itself
    one = df.orderBy(*NAMES, "sales").limit(1)
    single = create_model("random_forest", {"numTrees": 20}).fit(one, NAMES)  # bags without a row
    assert predictions(single, one) == pytest.approx([one.first().sales])
