"""Learners, tuning and model persistence as MLlib jobs (M-01..M-19, S-10, S-11, R-04..R-08).

Features arrive as a ``features`` vector column keyed by ``doc_id``; labels
as ``label`` (double).  Fitting, scoring and evaluation are distributed; only
scalar metrics and bounded model summaries reach the driver.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier,
                                       NaiveBayes, OneVsRest)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlens.operators import metrics as M
from reviewlens.operators.forest import SlotForest

SEED = 42


# M-01 -------------------------------------------------------------------------------
def build_pipeline(estimator, vectorizer_stages: list | None = None) -> Pipeline:
    """Pipeline of optional vectoriser stages followed by the estimator."""
    return Pipeline(stages=list(vectorizer_stages or []) + [estimator])


# M-02..M-09, M-15, R-07, S-10 ----------------------------------------------------------
@dataclass(frozen=True)
class Learner:
    """One entry of the registry: how to build the estimator, its short name in paths, its tuning grid.

    ``make(size, over)`` builds it; ``size`` has the training rows (penalties per row are MLlib's form of C and alpha), the
    width of the input and the classes.  ``grid(estimator, size)`` gives parameter -> candidate values.
    """

    title: str
    slug: str
    make: Callable
    grid: Callable = lambda est, size: {}


@dataclass(frozen=True)
class Size:
    rows: int
    features: int | None = None
    classes: int = 3


def _forest_grid(est, size):
    return {est.numTrees: FOREST_TREES, est.maxDepth: FOREST_DEPTH, est.minInstancesPerNode: FOREST_LEAF}


def _boost_grid(est, size):
    inner = est.getClassifier() if isinstance(est, OneVsRest) else est
    return {inner.maxIter: BOOST_ROUNDS, inner.maxDepth: BOOST_DEPTH, inner.stepSize: BOOST_RATE}


# Candidate values of the tuning grids.
LOGISTIC_C, LOGISTIC_ITERATIONS = [0.1, 1.0, 10.0], [500, 1000]
NB_SMOOTHING = [0.1, 0.5, 1.0]
RIDGE_ALPHA = [0.1, 1.0, 10.0]
FOREST_TREES, FOREST_DEPTH, FOREST_LEAF = [50, 100], [10, 20], [2, 5]
BOOST_ROUNDS, BOOST_DEPTH, BOOST_RATE = [50, 100], [5, 10], [0.05, 0.1]
#: Penalties that a random search draws from.
RIDGE_RANGE = [10.0 ** (e / 2) for e in range(-6, 9)]

LEARNERS = {
    "classification": {
        # tol as scikit-learn's lbfgs has it (MLlib's default is 1e-6)
        "logistic": Learner("Logistic Regression", "lr", lambda size, over: LogisticRegression(**{
            "family": "multinomial", "maxIter": 1000, "regParam": 1.0 / size.rows, "elasticNetParam": 0.0,
            "standardization": False, "tol": 1e-4, **over}),
            lambda est, size: {est.regParam: [1.0 / (c * size.rows) for c in LOGISTIC_C], est.maxIter: LOGISTIC_ITERATIONS}),
        "complement_nb": Learner("Complement NB", "complement_nb", lambda size, over: NaiveBayes(**{
            "modelType": "complement", "smoothing": 1.0, **over}), lambda est, size: {est.smoothing: NB_SMOOTHING}),
        "random_forest": Learner("Random Forest", "rf", lambda size, over: SlotForest(**{
            "numTrees": 100, "seed": SEED, **over}), _forest_grid),
        # GBTClassifier is binary only: one against the rest (raw predictions, no probability)
        "gbt": Learner("GBT", "gbt", lambda size, over: OneVsRest(
            classifier=GBTClassifier(**{"maxIter": 100, "seed": SEED, **over}), parallelism=3), _boost_grid),
        "mlp": Learner("MLP", "mlp", lambda size, over: MultilayerPerceptronClassifier(**{
            "layers": [size.features, 256, size.classes], "seed": SEED, "maxIter": 100, **over})),
        "linear_svm": Learner("Linear SVM", "svm", lambda size, over: OneVsRest(
            classifier=LinearSVC(**{"maxIter": 100, **over}), parallelism=3)),
    },
    "regression": {
        "linear": Learner("Linear Regression", "linear", lambda size, over: LinearRegression(**{"regParam": 0.0, **over})),
        "ridge": Learner("Ridge", "ridge", lambda size, over: LinearRegression(**{
            "regParam": 1.0 / size.rows, "elasticNetParam": 0.0, "standardization": False, **over}),
            lambda est, size: {est.regParam: [alpha / size.rows for alpha in RIDGE_ALPHA]}),
        "random_forest": Learner("Random Forest", "rf", lambda size, over: RandomForestRegressor(**{
            "numTrees": 100, "seed": SEED, **over}), _forest_grid),
        "gbt": Learner("GBT", "gbt", lambda size, over: GBTRegressor(**{"maxIter": 100, "seed": SEED, **over}), _boost_grid),
    },
}


def learner(name: str, task: str = "classification") -> Learner:
    """Registry entry by its exact name or title."""
    found = LEARNERS[task]
    by_title = {one.title: one for one in found.values()}
    if name not in found and name not in by_title:
        raise ValueError(f"no {task} learner {name!r}; there are {sorted(found)}")
    return found.get(name) or by_title[name]


def build(name: str, task: str, n_train: int, n_features: int | None = None, **over):
    """Estimator by name; ``over`` replaces parameters by their MLlib names."""
    return learner(name, task).make(Size(n_train, n_features), over)


def param_grid(name: str, est, task: str = "classification", n_train: int = 1) -> dict:
    """M-15: parameter -> candidate values of an estimator that ``build`` made."""
    return learner(name, task).grid(est, Size(n_train))


# M-14 --------------------------------------------------------------------------------
def predictions_to_scored(pred: DataFrame) -> DataFrame:
    return pred.select(F.col("label").cast("int").alias("y_true"), F.col("prediction").cast("int").alias("y_pred"))


def train_and_evaluate(pipeline: Pipeline, train: DataFrame, test: DataFrame, task: str = "classification",
                       classes=(0, 1, 2)):
    """Fit on train, score test; returns (fitted model, one-row metrics DataFrame, seconds)."""
    t0 = time.perf_counter()
    model = pipeline.fit(train)
    elapsed = time.perf_counter() - t0
    pred = model.transform(test)
    if task == "classification":
        m = M.metrics_basic(predictions_to_scored(pred), classes)
    else:
        m = M.regression_metrics(pred.select(F.col("label").alias("y_true"), F.col("prediction").alias("y_pred")))
    return model, m, elapsed


def result_row(m: DataFrame, model: str, representation: str, elapsed: float) -> DataFrame:
    return m.select(F.lit(model).alias("model"), F.lit(representation).alias("representation"), "*",
                    F.lit(round(elapsed, 3)).alias("train_time"))


# M-10 --------------------------------------------------------------------------------
def training_history(spark: SparkSession, model) -> DataFrame:
    """Objective per iteration from a fitted model's training summary (bounded by maxIter)."""
    hist = list(model.summary.objectiveHistory)
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(hist)], "iteration int, loss double")


# M-16 / M-17 evaluator ------------------------------------------------------------------
class MacroF1Evaluator(Evaluator):
    """Macro F1 over the union of true and predicted classes (MLlib's 'f1' is support-weighted)."""

    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self.labelCol, self.predictionCol = labelCol, predictionCol

    def _evaluate(self, dataset: DataFrame) -> float:
        s = dataset.select(F.col(self.labelCol).cast("int").alias("y_true"),
                           F.col(self.predictionCol).cast("int").alias("y_pred"))
        return float(M.summary(s).select("macro_f1").first()[0])

    def isLargerBetter(self) -> bool:
        return True


class RmseEvaluator(Evaluator):
    def _evaluate(self, dataset: DataFrame) -> float:
        return float(dataset.agg(F.sqrt(F.avg((F.col("label") - F.col("prediction")) ** 2))).first()[0])

    def isLargerBetter(self) -> bool:
        return False


# M-16 / M-17 ---------------------------------------------------------------------------
def expand_grid(grid: dict) -> list[dict]:
    b = ParamGridBuilder()
    for p, vals in grid.items():
        b = b.addGrid(p, vals)
    return b.build()


def drawn(options: list, n: int, seed: int = SEED) -> list:
    """``n`` of the options without repeats, seeded; all of them if there are no more."""
    return random.Random(seed).sample(options, min(n, len(options)))


def random_candidates(grid: dict, n_iter: int = 10, seed: int = SEED) -> list[dict]:
    """M-17: seeded sample of the expanded grid, min(n_iter, 1 + sum of option counts), never more than the grid."""
    return drawn(expand_grid(grid), min(n_iter, 1 + sum(len(v) for v in grid.values())), seed)


def cross_validate(pipeline_est, maps: list[dict], train: DataFrame, evaluator: Evaluator, fold_col: str = "fold",
                   parallelism: int = 2, k: int = 5):
    """M-16 / M-18: CrossValidator over a precomputed, stratified fold column with k folds."""
    cv = CrossValidator(estimator=pipeline_est, estimatorParamMaps=maps or [{}], evaluator=evaluator,
                        numFolds=k, foldCol=fold_col, parallelism=parallelism, seed=SEED)
    return cv.fit(train)


def cv_results(spark: SparkSession, cvm, maps: list[dict]) -> DataFrame:
    """R-08: one row per candidate: params, mean and std of the fold metric."""
    stds = list(cvm.stdMetrics) if cvm.stdMetrics else [None] * len(cvm.avgMetrics)
    rows = [(i, ", ".join(f"{p.name}={v}" for p, v in sorted(m.items(), key=lambda kv: kv[0].name)),
             float(a), None if s is None else float(s))
            for i, (m, a, s) in enumerate(zip(maps or [{}], cvm.avgMetrics, stds))]
    return spark.createDataFrame(rows, "candidate int, params string, mean_metric double, std_metric double")


# S-10 / S-11 ------------------------------------------------------------------------------
def model_path(base: str, task: str, model_name: str, representation: str) -> str:
    """``{base}/{task}/{slug}_{representation}``, the slug from the registry."""
    return f"{base.rstrip('/')}/{task}/{learner(model_name, task).slug}_{representation.lower().replace(' ', '_')}"


def representation_of(path: str) -> str:
    """Inverse of ``model_path`` for the representation (tfidf where the name has none)."""
    task, _, stem = path.rstrip("/").rpartition("/")
    slugs = {one.slug for one in LEARNERS.get(task.rpartition("/")[2], {}).values()}
    rests = [stem[len(slug) + 1:] for slug in slugs if stem.startswith(slug + "_")]
    return min(rests, key=len, default="tfidf")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# M-19 --------------------------------------------------------------------------------------
def linear_batches(coefficients, intercepts, classify: bool, batch_size: int = 4096):
    """Column function over an array column: a linear model applied to whole batches by Spark's batch inference.

    ``coefficients`` is classes x features (one row for a regression).  The matrices travel with the function, are built
    once a Python worker, and each Arrow batch is one matrix product.  ``classify`` gives the class of the greatest margin
    (the least of equals), else the value of the one row.
    """
    import numpy as np
    from pyspark.ml.functions import predict_batch_udf
    from pyspark.sql.types import DoubleType

    rows, shift = [[float(v) for v in r] for r in coefficients], [float(v) for v in intercepts]

    def load():
        w, b = np.array(rows).T, np.array(shift)

        def predict(features: np.ndarray) -> np.ndarray:
            margins = features @ w + b
            return margins.argmax(axis=1).astype(float) if classify else margins[:, 0]

        return predict

    return predict_batch_udf(load, return_type=DoubleType(), batch_size=batch_size, input_tensor_shapes=[[len(rows[0])]])
