"""Candidate models with their parameter lists, feature assembly and label coding."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import product

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasFitIntercept, HasLabelCol, HasPredictionCol
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.columns import col
from tallyloom.operators.iterative import products
from tallyloom.operators.split import per_class

FEATURES = "features"
LABEL = "label"
MAX_DEPTH = 30
TASKS = ("classification", "regression")


# least squares with non-negative weights ----------------------------------------------------------------------------

def non_negative_weights(gram: np.ndarray, xy: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """Minimise wᵀGw/2 − wᵀxy over w ≥ 0 by growing and shrinking the set of free weights."""
    width = len(xy)
    w = np.zeros(width)
    free = np.zeros(width, dtype=bool)
    tolerance = 1e-10 * max(np.abs(xy).max(initial=0.0), 1.0)
    for _ in range(rounds):
        slope = xy - gram @ w
        blocked = ~free & (slope > tolerance)
        if not blocked.any():
            break
        free[np.flatnonzero(blocked)[np.argmax(slope[blocked])]] = True
        while free.any():
            trial = np.zeros(width)
            trial[free] = np.linalg.lstsq(gram[np.ix_(free, free)], xy[free], rcond=None)[0]
            if (trial[free] > 0).all():
                w = trial
                break
            falling = free & (trial <= 0)
            step = np.min(w[falling] / (w[falling] - trial[falling]))
            w = w + step * (trial - w)
            free &= w > 1e-14
            w[~free] = 0.0
    return w


class _NonNegativeParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasFitIntercept):
    pass


class NonNegativeRegression(Estimator, _NonNegativeParams, DefaultParamsReadable, DefaultParamsWritable):
    """Linear regression with weights that are not negative.

    The data are read once for the matrix of products; the small problem on it is solved on the driver.
    """

    @keyword_only
    def __init__(self, *, featuresCol=FEATURES, labelCol=LABEL, predictionCol="prediction", fitIntercept=True):
        super().__init__()
        self._setDefault(featuresCol=FEATURES, labelCol=LABEL, predictionCol="prediction", fitIntercept=True)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> NonNegativeModel:
        first = dataset.select(vector_to_array(self.getFeaturesCol()).alias("x")).first()
        if first is None:
            raise ValueError("no rows to fit on")
        width = len(first["x"])
        x = vector_to_array(self.getFeaturesCol())
        wide = dataset.select(*[x[i].alias(f"x{i}") for i in range(width)], col(self.getLabelCol()).cast("double").alias("y"))
        n, means, centred = products(wide, [*[f"x{i}" for i in range(width)], "y"])
        total = centred if self.getFitIntercept() else centred + n * np.outer(means, means)
        w = non_negative_weights(total[:-1, :-1], total[:-1, -1])
        intercept = float(means[-1] - w @ means[:-1]) if self.getFitIntercept() else 0.0
        model = NonNegativeModel(weights=[float(v) for v in w], offset=intercept)
        return self._copyValues(model)


class NonNegativeModel(Model, _NonNegativeParams, DefaultParamsReadable, DefaultParamsWritable):
    weights = Param(Params._dummy(), "weights", "weights of the features", typeConverter=TypeConverters.toListFloat)
    offset = Param(Params._dummy(), "offset", "intercept", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, weights=None, offset=0.0):
        super().__init__()
        self._setDefault(featuresCol=FEATURES, labelCol=LABEL, predictionCol="prediction", fitIntercept=True)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def coefficients(self) -> np.ndarray:
        return np.array(self.getOrDefault(self.weights))

    @property
    def intercept(self) -> float:
        return self.getOrDefault(self.offset)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array(self.getFeaturesCol())
        total = F.lit(self.intercept)
        for i, w in enumerate(self.coefficients):
            total = total + F.lit(float(w)) * x[i]
        return dataset.withColumn(self.getPredictionCol(), total)


# candidates ---------------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Candidate:
    """A model family: its task, how to build it from parameters, and the parameter lists to search."""

    name: str
    task: str
    build: Callable[[Mapping, int, int], Estimator]
    params_grid: Mapping[str, Sequence] = field(default_factory=dict)
    params_random: Mapping[str, Sequence] = field(default_factory=dict)


def _forest(kind):
    def build(params: Mapping, rows: int, seed: int) -> Estimator:
        depth = params.get("max_depth")
        return kind(
            featuresCol=FEATURES, labelCol=LABEL, numTrees=params.get("n_estimators", 100),
            maxDepth=MAX_DEPTH if depth is None else min(depth, MAX_DEPTH),
            minInstancesPerNode=max(1, params.get("min_samples_split", 2) // 2), seed=seed)

    return build


def _logistic(max_iter: int):
    def build(params: Mapping, rows: int, seed: int) -> Estimator:
        """The penalty weight C counts against the sum of losses, Spark's against their mean."""
        return LogisticRegression(
            featuresCol=FEATURES, labelCol=LABEL, maxIter=max_iter, regParam=1.0 / (params.get("C", 1.0) * max(rows, 1)),
            elasticNetParam=0.0, standardization=False)

    return build


def _linear(params: Mapping, rows: int, seed: int) -> Estimator:
    intercept = params.get("fit_intercept", True)
    if params.get("positive", False):
        return NonNegativeRegression(fitIntercept=intercept)
    return LinearRegression(featuresCol=FEATURES, labelCol=LABEL, solver="normal", regParam=0.0, fitIntercept=intercept)


# The parameter lists of the standard candidates.
FOREST_RANDOM = {"n_estimators": [50, 100, 200, 300], "max_depth": [3, 5, 10, None], "min_samples_split": [2, 5, 10]}
FOREST_GRID = {"n_estimators": [50], "max_depth": [5], "min_samples_split": [2]}
LINEAR_LISTS = {"fit_intercept": [True, False], "positive": [True, False]}


def random_forest() -> Candidate:
    return Candidate("RandomForest", "classification", _forest(RandomForestClassifier), FOREST_GRID, FOREST_RANDOM)


def random_forest_regressor() -> Candidate:
    return Candidate("RandomForestRegressor", "regression", _forest(RandomForestRegressor), FOREST_GRID, FOREST_RANDOM)


def logistic_regression(max_iter: int = 100) -> Candidate:
    return Candidate("LogisticRegression", "classification", _logistic(max_iter), {"C": [1.0]}, {"C": [0.1, 1.0, 10.0]})


def linear_regression() -> Candidate:
    return Candidate("LinearRegression", "regression", _linear, LINEAR_LISTS, LINEAR_LISTS)


def combinations_of(lists: Mapping[str, Sequence]) -> list[dict]:
    """Every combination of the listed values; a single value counts as a list of one."""
    if not lists:
        return []
    values = [v if isinstance(v, (list, tuple, range)) else [v] for v in lists.values()]
    return [dict(zip(lists, choice)) for choice in product(*values)]


def check_task(task: str, candidates: Sequence[Candidate]) -> None:
    if task not in TASKS:
        raise ValueError(f"task must be one of {TASKS}, got {task!r}")
    for c in candidates:
        if c.task != task:
            raise ValueError(f"model {c.name!r} does {c.task}, but the task is {task}")


# features and labels ------------------------------------------------------------------------------------------------

def with_code(df: DataFrame, label: str, classes: Sequence) -> DataFrame:
    """Add the label as Spark ML expects it: the position of the class in sorted order."""
    codes = {(cls,): float(i) for i, cls in enumerate(classes)}
    return df.withColumn(LABEL, per_class(df, label, codes, "double"))


def classes_of(df: DataFrame, label: str, limit: int = 1000) -> list:
    """The sorted class labels; a column with very many values is not a label."""
    rows = df.select(col(label)).filter(col(label).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{label!r} has more than {limit} values; it is not a class label")
    return sorted(r[0] for r in rows)


def assembled(estimator: Estimator, features: Sequence[str]) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol=FEATURES), estimator])


def fit_model(candidate: Candidate, params: Mapping, df: DataFrame, features: Sequence[str], rows: int, seed: int = 42):
    """Fit a candidate on a frame that has the `label` column."""
    return assembled(candidate.build(params, rows, seed), features).fit(df)


def scored(model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(keep…, label, prediction, probability): predictions, with class probabilities where the model has them."""
    out = model.transform(df)
    cells = [F.col("prediction")]
    if "probability" in out.columns:
        cells.append(vector_to_array("probability").alias("probability"))
    return out.select(*[col(k) for k in keep], col(LABEL).cast("double").alias(LABEL), *cells)
