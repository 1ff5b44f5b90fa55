"""Evaluate trained models on train and test rows: one scored table, all metrics from it."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.columns import col
from tallyloom.operators import curves, metrics
from tallyloom.operators.importance import importances
from tallyloom.operators.learning import SIZES, learning_curve
from tallyloom.operators.models import LABEL, Candidate, classes_of, scored, with_code
from tallyloom.operators.search import Trained, score_table
from tallyloom.session import checkpointed
from tallyloom.sources.sinks import metrics_summary, write_markdown


def score_models(trained: Sequence[Trained], rows: DataFrame, label: str, key: str, task: str) -> DataFrame:
    """(model, key, split, label, prediction, probability) of all models over rows with a split column."""
    if task == "classification":
        rows = with_code(rows, label, classes_of(rows, label))
    else:
        rows = rows.withColumn(LABEL, col(label).cast("double"))
    parts = [scored(t.model, rows, [key, "split"]).withColumn("model", F.lit(t.name)) for t in trained]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def evaluate_regression(table: DataFrame) -> DataFrame:
    return metrics.regression_metrics(table, LABEL, "prediction", ["model", "split"])


def tuned(table: DataFrame, minimum_precision: float | None = None, minimum_recall: float | None = None) -> DataFrame:
    """Binary predictions at the threshold with the best F1 on the training rows of each model."""
    hits = table.withColumns({"hit": F.col(LABEL).cast("int"), "score": F.col("probability")[1]})
    cuts = curves.best_threshold(hits.filter("split = 'train'"), "hit", "score", ["model"], minimum_precision, minimum_recall)
    cuts = cuts.select(F.col("model").alias("_model"), "threshold")
    joined = hits.join(F.broadcast(cuts), F.col("model") == F.col("_model"))  # one row per model
    return curves.apply_threshold(joined, "score", F.col("threshold")).withColumn("prediction", F.col("prediction").cast("double")).drop("_model")


def evaluate_classification(table: DataFrame, classes: int, minimum_precision: float | None = None,
                            minimum_recall: float | None = None) -> DataFrame:
    """Scores and curve areas per model and split.  Two classes are judged at the tuned threshold."""
    by = ["model", "split"]
    if classes == 2:
        table = tuned(table, minimum_precision, minimum_recall)
    scores = metrics.classification_metrics(table, LABEL, "prediction", by, averaged=classes > 2)
    areas = curves.curve_areas(_class_scores(table, classes), "hit", "score", [*by, "class"]).groupBy(*by).agg(
        F.avg("roc_auc").alias("roc_auc"), F.avg("pr_auc").alias("pr_auc"))
    return scores.join(areas, by)


def _class_scores(table: DataFrame, classes: int) -> DataFrame:
    """(model, split, class, score, hit): one row per row and class, of two classes the larger alone."""
    long = table.select("model", "split", LABEL, F.posexplode("probability").alias("class", "score")).withColumn(
        "hit", (F.col(LABEL) == F.col("class")).cast("int"))
    return long.filter("class = 1") if classes == 2 else long


def classification_tables(table: DataFrame, classes: int) -> dict[str, DataFrame]:
    """Curves of every model, split and class, calibration and confusion, from a scored table of these columns."""
    by = ["model", "split"]
    long = _class_scores(table, classes)
    return {
        "roc_curve": curves.roc_curve(long, "hit", "score", [*by, "class"]),
        "pr_curve": curves.pr_curve(long, "hit", "score", [*by, "class"]),
        "areas": curves.curve_areas(long, "hit", "score", [*by, "class"]),
        "calibration": metrics.calibration_curve(long, "hit", "score", [*by, "class"]),
        "confusion": metrics.confusion_matrix(table, LABEL, "prediction", by),
    }


def mean_areas(table: DataFrame, classes: int) -> DataFrame:
    """(model, split, curve, area): area under the class curves averaged on all their x, for each model and split."""
    found = []
    scores = {float(i): f"_p{i}" for i in range(classes)}
    wide = table.withColumns({name: F.col("probability")[int(i)] for i, name in scores.items()})
    for r in sorted(table.select("model", "split").distinct().collect()):  # one row per model and split
        own = wide.filter((F.col("model") == r["model"]) & (F.col("split") == r["split"]))
        for kind in ("roc", "pr"):
            area = curves.curve_area(curves.mean_curve(own, LABEL, scores, kind))
            found.append(area.select(F.lit(r["model"]).alias("model"), F.lit(r["split"]).alias("split"), F.lit(kind).alias("curve"), "area"))
    return reduce(DataFrame.unionByName, found)


def regression_tables(table: DataFrame, bins: int = 30) -> dict[str, DataFrame]:
    """Residuals of every row, and how many fall into equal bins between each model's smallest and largest one."""
    residuals = metrics.residual_diagnostics(table, LABEL, "prediction", ["model", "split"])
    ends = residuals.groupBy("model").agg(F.min("residual").alias("low"), F.max("residual").alias("high"))
    width = F.greatest((F.col("high") - F.col("low")) / bins, F.lit(1e-300))
    place = F.least(F.floor((F.col("residual") - F.col("low")) / width), F.lit(bins - 1))
    counts = residuals.join(ends, "model").groupBy("model", "split", place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return {"residuals": residuals, "residual_bins": counts}


@dataclass
class Report:
    """Everything about some trained models: the scored table, tables by name, and the seconds each model took."""

    scored: DataFrame
    tables: dict[str, DataFrame]
    seconds: dict[str, float]


def report(trained: Sequence[Trained], rows: DataFrame, label: str, key: str, features: Sequence[str], task: str = "classification",
           minimum_precision: float | None = None, minimum_recall: float | None = None, repeats: int = 5,
           summary_path: str | None = None, candidates: Sequence[Candidate] = (), sizes: Sequence[float] = SIZES, folds: int = 5,
           metric: str | None = None, seed: int = 42) -> Report:
    """Metrics, curves, confusion, calibration or residuals, and importances of all models; each model is scored once.

    `summary_path` stores the summary as Markdown. Importances of models without weights come from shuffled test rows. The
    `candidates` that models came from give their learning curves over train rows, with the parameters found; more than two
    classes also give the areas under averaged curves.
    """
    classes = len(classes_of(rows, label)) if task == "classification" else 0
    parts, seconds = [], {}
    for t in trained:
        started = time.time()
        parts.append(checkpointed(score_models([t], rows, label, key, task)))
        seconds[t.name] = time.time() - started
    table = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if task == "regression":
        tables = {"metrics": evaluate_regression(table), **regression_tables(table)}
        coded = rows.withColumn(LABEL, col(label).cast("double"))
    else:
        tables = {"metrics": evaluate_classification(table, classes, minimum_precision, minimum_recall), **classification_tables(table, classes)}
        coded = with_code(rows, label, classes_of(rows, label))
    if classes > 2:
        tables["mean_areas"] = mean_areas(table, classes)
    metric = metric or ("r2" if task == "regression" else "accuracy")
    test = coded.filter("split = 'test'")
    tables["importances"] = reduce(DataFrame.unionByName, [
        importances(rows.sparkSession, t.model, test, features, key, t.name,
                    lambda df, by: score_table(df, metric, by, max(2, classes)), repeats) for t in trained])
    families = {c.name: c for c in candidates}
    train = rows.filter("split = 'train'")
    learned = [
        learning_curve(families[t.name], t.best_params, train, label, features, key, metric, sizes, folds, seed).withColumn("model", F.lit(t.name))
        for t in trained if t.name in families]
    if learned:
        tables["learning_curve"] = reduce(DataFrame.unionByName, learned)
    tables["summary"] = summary(tables["metrics"], task)
    if summary_path:
        write_markdown(tables["summary"], summary_path)
    return Report(table, tables, seconds)


def evaluate(trained: Sequence[Trained], rows: DataFrame, label: str, key: str, task: str = "classification",
             minimum_precision: float | None = None, minimum_recall: float | None = None) -> DataFrame:
    """One row per model and split.  The predictions are written once and read by every metric."""
    table = checkpointed(score_models(trained, rows, label, key, task))
    if task == "regression":
        return evaluate_regression(table)
    classes = len(classes_of(rows, label))
    return evaluate_classification(table, classes, minimum_precision, minimum_recall)


def summary(results: DataFrame, task: str = "classification") -> DataFrame:
    """One row per model with `test (train)` texts."""
    names = metrics.REGRESSION_METRICS if task == "regression" else (*metrics.CLASSIFICATION_METRICS, "roc_auc", "pr_auc")
    return metrics_summary(results, names)
