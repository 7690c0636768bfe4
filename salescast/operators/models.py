"""Regressors on Spark ML: fit, predict, importance, save, load, and the registry.

The two boosted models stand in for external gradient boosting libraries. Spark ML has no leaf penalties
and grows level by level, so they promise the behaviour of boosted trees, not equal values.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from math import ceil
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel, regression
from pyspark.ml.feature import SQLTransformer, VectorAssembler, VectorSlicer
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescast.functions.stores import floor_at_zero
from salescast.operators.forest import Tree, fit_forest, mean_of, trees_of
from salescast.session import scratch_path, shared_folder, small_table, written
from salescast.sources.schemas import FEATURES, TARGET

log = logging.getLogger(__name__)

VECTOR = "features"

# Default size of each model. A leaf of five rows implies that a split needs ten.
DEFAULTS: dict[str, dict[str, Any]] = {
    "linear_regression": {"regParam": 0.0, "fitIntercept": True, "tol": 1e-12, "maxIter": 1000},
    "random_forest": {
        "numTrees": 100, "maxDepth": 15, "minInstancesPerNode": 5, "featureSubsetStrategy": "all",
        "subsamplingRate": 1.0, "maxBins": 256, "maxMemoryInMB": 256, "seed": 42,
    },
    "boosted_deep": {
        "maxIter": 500, "maxDepth": 10, "stepSize": 0.05, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8",
        "minInstancesPerNode": 5, "maxBins": 256, "maxMemoryInMB": 1024, "checkpointInterval": 10, "seed": 42,
    },
    "boosted_leaf": {
        "maxIter": 500, "maxDepth": 5, "stepSize": 0.05, "subsamplingRate": 1.0, "featureSubsetStrategy": "0.8",
        "minInstancesPerNode": 20, "maxBins": 256, "maxMemoryInMB": 1024, "checkpointInterval": 10, "seed": 42,
    },
}

ESTIMATORS = {
    "linear_regression": LinearRegression,
    "random_forest": RandomForestRegressor,
    "boosted_deep": GBTRegressor,
    "boosted_leaf": GBTRegressor,
}

DISPLAY_NAMES = {
    "linear_regression": "LinearRegression",
    "random_forest": "RandomForest",
    "boosted_deep": "BoostedDeep",
    "boosted_leaf": "BoostedLeaf",
}

# Groups that the trees of a forest are dealt to, each a model of Spark ML, so that none is too large to be loaded at once.
FOREST_GROUPS = 10
# Rounds of boosting between two written states.
SEGMENT_ROUNDS = 100
# Least rows of a task while boosted trees are fitted: each makes and shuffles the statistics of every node, for a deep tree far more
# bytes than its rows have. And rows of a node up to which one task grows the rest of a forest's tree.
FIT_ROWS, GROUP_ROWS = 50_000, 500_000


def at_once(spark: SparkSession, calls: list[Callable[[], Any]], most: int = 8) -> list[Any]:
    """The results of calls that run Spark jobs, from up to ``most`` driver threads that inherit job group and other local properties.

    With the FAIR scheduler each has a pool of its own. The first error is raised once all have ended.
    """
    context = spark.sparkContext

    def pooled(call: Callable[[], Any], pool: str) -> Callable[[], Any]:
        def run() -> Any:
            context.setLocalProperty("spark.scheduler.pool", pool)
            return call()

        return inheritable_thread_target(spark)(run)

    outer = context.getLocalProperty("spark.scheduler.pool") or "fit"
    with ThreadPoolExecutor(max(1, min(most, len(calls)))) as threads:
        running = [threads.submit(pooled(call, f"{outer}-{i}")) for i, call in enumerate(calls)]
    return [one.result() for one in running]


def dealt(train: DataFrame, rows: int, per_task: int) -> DataFrame:
    """A small table over as many tasks as it is worth and the cluster has; a large one as it is."""
    tasks, cores = ceil(rows / per_task), train.sparkSession.sparkContext.defaultParallelism
    return train if tasks > 4 * cores else train.repartition(max(1, min(tasks, cores)))


def _varying(df: DataFrame, features: list[str]) -> list[int]:
    """Positions of the features that have more than one value, or a missing one, from one aggregation."""
    missing = [F.max(F.col(f).isNull() | F.isnan(F.col(f).cast("double"))) for f in features]
    row = df.agg(*[((F.min(f) < F.max(f)) | lost).alias(f"_{i}") for i, (f, lost) in enumerate(zip(features, missing))]).first()
    return [i for i in range(len(features)) if row[i]]


class SalesModel:
    """A regressor with its feature list; predictions never fall below zero."""

    def __init__(self, kind: str, params: dict[str, Any] | None = None):
        self.kind = kind
        self.name = DISPLAY_NAMES[kind]
        self.params = {**DEFAULTS[kind], **(params or {})}
        self.fitted: PipelineModel | None = None
        self._trees: tuple[PipelineModel, list[Tree] | None] | None = None

    def __repr__(self) -> str:
        state = f"fitted on {len(self.features)} features" if self.is_fitted else "not fitted"
        return f"<{self.kind}, {state}, {self.params}>"

    @property
    def is_fitted(self) -> bool:
        return self.fitted is not None

    @property
    def features(self) -> list[str]:
        return self._require_fit().stages[0].getInputCols()

    @property
    def regressors(self) -> list:
        """The fitted estimators: one, or the groups of a forest, or the segments of boosting."""
        return [stage for stage in self._require_fit().stages if hasattr(stage, "getPredictionCol")]

    @property
    def regressor(self):
        return self.regressors[0]

    def _require_fit(self) -> PipelineModel:
        if self.fitted is None:
            raise ValueError(f"{self.name} is not fitted")
        return self.fitted

    def fit(self, train: DataFrame, features: list[str] = FEATURES, target: str = TARGET, resume: str | None = None) -> SalesModel:
        """Fit on the feature columns of ``train``; a missing feature value raises.

        Boosting writes its state below ``resume`` after every segment; a later call with the same folder, data and parameters goes
        on after the last one written.
        """
        assembler = VectorAssembler(inputCols=list(features), outputCol=VECTOR, handleInvalid="error")
        rows = assembler.transform(train.select(*features, target)).select(VECTOR, F.col(target).cast("double").alias(target))
        if self.kind == "linear_regression":
            # A constant feature makes the normal equations singular; without it they are solved exactly.
            slicer = VectorSlicer(inputCol=VECTOR, outputCol="varying", indices=_varying(train, features) or [0])
            # What the slicer would give, from the columns: a vector less to make of each row.
            direct = VectorAssembler(inputCols=[features[i] for i in slicer.getIndices()], outputCol="varying", handleInvalid="error")
            rows = direct.transform(train.select(*features, target)).select("varying", F.col(target).cast("double").alias(target))
            stages = [slicer, self._estimator(target, "prediction", "varying").fit(rows)]
        elif self.kind == "random_forest":
            stages = self._fit_groups(rows, target)
        else:
            shared_folder(train.sparkSession)  # boosting cuts its lineage there
            stages = self._fit_segments(rows, target, resume)
        self.fitted = PipelineModel([assembler, *stages])
        return self

    def _estimator(self, target: str, output: str, vector: str = VECTOR, **changed: Any):
        params = {**self.params, **changed}
        return ESTIMATORS[self.kind](featuresCol=vector, labelCol=target, predictionCol=output, **params)

    def _fit_groups(self, rows: DataFrame, target: str) -> list:
        """A forest as models of some of its trees each; its prediction is the mean over all trees."""
        trees = self.params["numTrees"]
        sizes = [len(range(i, trees, FOREST_GROUPS)) for i in range(min(FOREST_GROUPS, trees))]
        estimators = [self._estimator(target, f"group_{i}", numTrees=n, seed=self.params["seed"] + i) for i, n in enumerate(sizes)]
        nominal = "nominal" in rows.schema[VECTOR].metadata.get("ml_attr", {}).get("attrs", {})
        if nominal or estimators[0].isSet("weightCol") or estimators[0].getMinWeightFractionPerNode():  # what only Spark ML has
            rows = dealt(rows, rows.count(), GROUP_ROWS)
            groups = at_once(rows.sparkSession, [lambda e=e: e.fit(rows) for e in estimators], FOREST_GROUPS)
        else:
            groups = fit_forest(rows, estimators, GROUP_ROWS, at_once)
        mean = " + ".join(f"group_{i} * {n}" for i, n in enumerate(sizes))
        return [*groups, SQLTransformer(statement=f"SELECT *, ({mean}) / {trees} AS prediction FROM __THIS__")]

    def _fit_segments(self, rows: DataFrame, target: str, resume: str | None) -> list:
        """Boosting in segments, each on what the ones before leave unexplained; their predictions are added up."""
        rounds = self.params["maxIter"]
        sizes = [min(SEGMENT_ROUNDS, rounds - done) for done in range(0, rounds, SEGMENT_ROUNDS)]
        folder = resume or scratch_path(rows.sparkSession, "segments")
        model_type, segments, done = type(self._estimator(target, "")).__name__.replace("Regressor", "RegressionModel"), [], 0
        load = getattr(regression, model_type).load
        if resume:
            self._check_plan(rows, target, f"{folder}/plan")
        while resume and done < len(sizes) and (left := written(rows.sparkSession, f"{folder}/left-{done}")) is not None:
            segments.append(load(f"{folder}/segment-{done}"))
            rows, done = left, done + 1
        for number in range(done, len(sizes)):
            rows = dealt(rows, rows.count(), FIT_ROWS)
            segment = self._estimator(target, f"segment_{number}", maxIter=sizes[number], seed=self.params["seed"] + number).fit(rows)
            segments.append(segment)
            if resume or number + 1 < len(sizes):
                segment.write().overwrite().save(f"{folder}/segment-{number}")
                left = segment.transform(rows).select(VECTOR, (F.col(target) - F.col(f"segment_{number}")).alias(target))
                left.write.mode("overwrite").parquet(f"{folder}/left-{number}")  # last: what is there is whole
                rows = written(rows.sparkSession, f"{folder}/left-{number}")
                log.info("%s: %d of %d segments", self.name, number + 1, len(sizes))
        total = " + ".join(f"segment_{i}" for i in range(len(sizes)))
        return [*segments, SQLTransformer(statement=f"SELECT *, {total} AS prediction FROM __THIS__")]

    def _check_plan(self, rows: DataFrame, target: str, path: str) -> None:
        """Note what is fitted where a run can be resumed; a state of something else is refused."""
        facts = rows.agg(F.count(F.lit(1)), F.min(target), F.max(target)).first()
        plan = json.dumps([self.kind, self.params, SEGMENT_ROUNDS, len(rows.first()[VECTOR]), *map(float, facts)], sort_keys=True)
        if (known := written(rows.sparkSession, path)) is None:
            small_table(rows.sparkSession, [(plan,)], plan="string").write.mode("overwrite").parquet(path)
        elif known.first().plan != plan:
            raise ValueError(f"{path} belongs to another fit: {known.first().plan}")

    def assemble(self, df: DataFrame) -> DataFrame:
        """Adds the feature vector, unless ``df`` has it already."""
        return df if VECTOR in df.columns else self._require_fit().stages[0].transform(df)

    def predict(self, df: DataFrame, output: str = "yhat") -> DataFrame:
        """Adds the prediction, floored at zero, and keeps every row."""
        scored = self.assemble(df)
        if self.kind == "random_forest" and (trees := self._forest(df.sparkSession)):
            scored = scored.withColumn("prediction", mean_of(trees, VECTOR))
        else:
            for stage in self._require_fit().stages[1:]:
                scored = stage.transform(scored)
        return scored.select(*df.columns, floor_at_zero(F.col("prediction")).cast("double").alias(output))

    def _forest(self, spark: SparkSession) -> list[Tree] | None:
        """The trees of a forest as arrays, read once for a fit; None if only Spark ML can score them."""
        fitted = self._require_fit()
        if self._trees is None or self._trees[0] is not fitted:
            self._trees = fitted, trees_of(self.regressors, spark, at_once)
        return self._trees[1]

    def coefficients(self) -> list[float]:
        """Coefficients of a linear model, one per feature; constant features have 0."""
        selected = self._require_fit().stages[1].getIndices()
        known = dict(zip(selected, self.regressor.coefficients.toArray()))
        return [float(known.get(i, 0.0)) for i in range(len(self.features))]

    def importance_values(self) -> list[float]:
        """Absolute coefficients of a linear model, importances of a tree model, one per feature."""
        if self.kind == "linear_regression":
            return [abs(c) for c in self.coefficients()]
        # Importances are means over trees.
        trees = [len(r.trees) if self.kind == "random_forest" else r.getNumTrees for r in self.regressors]
        parts = [r.featureImportances.toArray() * n for r, n in zip(self.regressors, trees)]
        return [float(v) for v in sum(parts) / sum(trees)]

    def importance(self, spark: SparkSession, feature_names: list[str] | None = None) -> DataFrame:
        """(feature, importance) in descending order; empty if the model is not fitted."""
        values = self.importance_values() if self.is_fitted else []
        names = feature_names or [f"feature_{i}" for i in range(len(values))]
        table = small_table(spark, list(zip(names, values)), feature="string", importance="double")
        return table.orderBy(F.desc("importance"), "feature")

    def save(self, path: str) -> None:
        self._require_fit().write().overwrite().save(path)

    def load(self, path: str) -> SalesModel:
        """Take over a saved model; one of another kind of regressor is refused."""
        loaded = PipelineModel.load(path)
        regressors = [stage for stage in loaded.stages if hasattr(stage, "getPredictionCol")]
        found, wanted = type(regressors[0]).__name__, f"{ESTIMATORS[self.kind].__name__.removesuffix('Regressor')}"
        if not found.startswith(wanted):
            raise ValueError(f"{path} holds a {found}, not a model for {self.kind}")
        self.fitted = loaded
        return self


def available_models() -> list[str]:
    return list(ESTIMATORS)


def create_model(name: str, params: dict[str, Any] | None = None) -> SalesModel:
    """A new model by registry name, in any case."""
    kind = name.lower()
    if kind not in ESTIMATORS:
        raise ValueError(f"unknown model {name!r}; available: {available_models()}")
    return SalesModel(kind, params)


def create_all_models(params: dict[str, dict[str, Any]] | None = None) -> list[SalesModel]:
    return [create_model(name, (params or {}).get(name)) for name in available_models()]
