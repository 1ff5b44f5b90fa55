"""Cross-validated search over candidate parameters, with resampling on training folds only.

Folds and candidates are independent Spark jobs, submitted from a few driver threads; the rows
they share are persisted once.
"""

from __future__ import annotations

import logging
import math
import random
import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.columns import col, require
from tallyloom.operators import curves, metrics
from tallyloom.operators.models import (
    LABEL, Candidate, check_task, classes_of, combinations_of, fit_model, scored, with_code,
)
from tallyloom.operators.resample import choose_sampler
from tallyloom.operators.split import with_folds
from tallyloom.session import scratch_path
from tallyloom.sources.sinks import save_model

log = logging.getLogger(__name__)

FOLD = "_fold"

# Metric names, the task they belong to, and their column and sign.
METRICS = {
    "accuracy": ("classification", "accuracy", 1), "precision": ("classification", "precision", 1),
    "recall": ("classification", "recall", 1), "f1": ("classification", "f1", 1),
    "roc_auc": ("classification", "roc_auc", 1), "average_precision": ("classification", "pr_auc", 1),
    "r2": ("regression", "r2", 1), "explained_variance": ("regression", "explained_variance", 1),
    "neg_root_mean_squared_error": ("regression", "rmse", -1), "neg_mean_absolute_error": ("regression", "mae", -1),
    "neg_median_absolute_error": ("regression", "median_ae", -1),
    "neg_mean_absolute_percentage_error": ("regression", "mape", -1),
}


def check_metric(metric: str, task: str) -> None:
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; use one of {sorted(METRICS)}")
    if METRICS[metric][0] != task:
        raise ValueError(f"metric {metric!r} does not fit a {task} task")


def score_table(rows: DataFrame, metric: str, by: Sequence[str] = (), classes: int = 2) -> DataFrame:
    """(by…, score) of a scored table; larger is better. `classes` counts the labels of the whole table."""
    _, column, sign = METRICS[metric]
    if column in ("roc_auc", "pr_auc"):
        table = _areas(rows, column, by)
    elif METRICS[metric][0] == "classification":
        positive = 1.0 if classes == 2 else None  # codes of two classes: 0, 1
        table = metrics.classification_metrics(rows, LABEL, "prediction", by, positive, averaged=classes > 2)
    else:
        table = metrics.regression_metrics(rows, LABEL, "prediction", by, with_median=column == "median_ae")
    return table.select(*[col(b) for b in by], (sign * F.col(column)).alias("score"))


def _areas(rows: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """Area of the positive class, or the mean over classes when there are more than two."""
    long = rows.select(*[col(b) for b in by], LABEL, F.posexplode("probability").alias("class", "score"),
                       F.size("probability").alias("_classes"))
    long = long.filter("_classes > 2 OR class = 1").withColumn("hit", (F.col(LABEL) == F.col("class")).cast("int"))
    return curves.curve_areas(long, "hit", "score", [*by, "class"]).groupBy(*[col(b) for b in by]).agg(F.avg(column).alias(column))


def score_of(rows: DataFrame, metric: str, classes: int = 2) -> float | None:
    return score_table(rows, metric, classes=classes).first()["score"]


@dataclass
class Trial:
    params: dict
    scores: list[float]

    @property
    def mean(self) -> float:
        return sum(self.scores) / len(self.scores)


@dataclass
class Trained:
    """A fitted candidate: its best parameters, their cross-validated score, fit time and stored size."""

    name: str
    model: object
    best_params: dict
    cv_score: float
    seconds: float
    size_kb: float
    trials: list[Trial]


def choose_trials(candidate: Candidate, kind: str, n_iter: int, seed: int) -> list[dict]:
    """All combinations for a grid; for a random search a seeded draw of at most n_iter of them."""
    if kind == "grid":
        return combinations_of(candidate.params_grid) or [{}]
    if kind == "random":
        every = combinations_of(candidate.params_random) or [{}]
        return random.Random(seed).sample(every, min(n_iter, len(every)))
    raise ValueError(f"search must be 'grid' or 'random', got {kind!r}")


def _train_rows(df: DataFrame, features: Sequence[str], key: str, sampler: Callable | None, seed: int) -> DataFrame:
    """The rows a model is fitted on: those given, or their resampled form."""
    if sampler is None:
        return df
    return sampler(df.select(col(key), col(LABEL), *[col(f) for f in features]), LABEL, features, key, seed=seed)


def search(candidate: Candidate, trials: Sequence[Mapping], folded: DataFrame, features: Sequence[str], key: str,
           folds: int, metric: str, sampler: Callable | None = None, seed: int = 42, parallelism: int = 4,
           classes: int = 2) -> list[Trial]:
    """Score every parameter choice on every fold.  `folded` has the label and the fold number.

    A fold that gives no score is an error: means over different folds can't be compared.
    """
    sizes = {r[FOLD]: r["n"] for r in folded.groupBy(FOLD).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())

    def fold_scores(fold: int) -> list[float]:
        if not sizes.get(fold):
            raise ValueError(f"fold {fold} has no rows and gives no {metric}")
        train = _train_rows(folded.filter(F.col(FOLD) != fold).drop(FOLD), features, key, sampler, seed)
        valid = folded.filter(F.col(FOLD) == fold)
        if sampler is not None:
            train = train.persist(StorageLevel.MEMORY_AND_DISK)
        out = []
        try:
            for params in trials:
                model = fit_model(candidate, params, train, features, total - sizes.get(fold, 0), seed)
                score = score_of(scored(model, valid, []), metric, classes)
                if score is None or math.isnan(score):
                    raise ValueError(f"fold {fold} gives no {metric} for {dict(params)}")
                out.append(score)
        finally:
            if sampler is not None:
                train.unpersist()
        return out

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, folds))) as pool:
        columns = list(pool.map(inheritable_thread_target(folded.sparkSession)(fold_scores), range(folds)))
    return [Trial(dict(params), [column[i] for column in columns]) for i, params in enumerate(trials)]


def train_all(candidates: Sequence[Candidate], df: DataFrame, label: str, features: Sequence[str], key: str,
              task: str = "classification", metric: str = "accuracy", search_type: str = "grid", folds: int = 5,
              n_iter: int = 10, resampling: str | None = None, seed: int = 42, model_dir: str | None = None,
              parallelism: int = 4) -> tuple[list[Trained], dict[str, str]]:
    """Search, refit and store every candidate.  Returns the trained models and the errors of those that failed."""
    check_task(task, candidates)
    check_metric(metric, task)
    require(df, label, key, *features)
    spark = df.sparkSession
    sampler = choose_sampler(resampling) if task == "classification" else None
    root = model_dir or scratch_path(spark, "models")
    rows = df.select(col(key), col(label), *[col(f) for f in features if f not in (key, label)])
    labels: list = []
    if task == "classification":
        labels = classes_of(rows, label)
        rows = with_code(rows, label, labels)
        rows = rows.drop(label) if label != LABEL else rows
        folded = with_folds(rows, [key], folds, stratify=LABEL, seed=seed, name=FOLD)
    else:
        rows = rows.withColumn(LABEL, col(label).cast("double"))
        folded = with_folds(rows, [key], folds, seed=seed, name=FOLD)
    folded = folded.persist(StorageLevel.MEMORY_AND_DISK)
    trained, errors = [], {}
    try:
        count = folded.count()
        for candidate in candidates:
            started = time.time()
            try:
                trials = search(candidate, choose_trials(candidate, search_type, n_iter, seed), folded, features, key, folds,
                                metric, sampler, seed, parallelism, max(2, len(labels)))
                best = max(trials, key=lambda t: t.mean)
                final = _train_rows(folded.drop(FOLD), features, key, sampler, seed)
                model = fit_model(candidate, best.params, final, features, count, seed)
                size = save_model(spark, model, f"{root}/{candidate.name.replace(' ', '_').lower()}")
                trained.append(Trained(candidate.name, model, best.params, best.mean, time.time() - started, size, trials))
            except Exception as error:  # one candidate must not stop the others
                log.warning("training %s failed: %s", candidate.name, error)
                errors[candidate.name] = str(error)
    finally:
        folded.unpersist()
    return trained, errors


def training_report(spark, trained: Sequence[Trained], errors: Mapping[str, str] | None = None) -> DataFrame:
    """One row per model and parameter choice: mean score, whether it was best, fit time and size.

    A candidate that failed has one row with its error and nothing else.
    """
    rows = [
        (t.name, str(trial.params), float(trial.mean), trial.params == t.best_params, float(t.seconds), float(t.size_kb), None)
        for t in trained for trial in t.trials
    ]
    rows += [(name, None, None, None, None, None, error) for name, error in (errors or {}).items()]
    return spark.createDataFrame(
        rows, "model string, params string, cv_score double, is_best boolean, seconds double, size_kb double, error string")
