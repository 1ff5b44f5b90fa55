"""Metrics of a scored table: one row per case with label, prediction and score.

Every metric takes `by` columns (model, split, class …) and returns one row per group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.columns import col, number
from tallyloom.functions.running import quantiles_by
from tallyloom.functions.selection import exact_quantiles
from tallyloom.functions.stats import divide, divide_or_zero

# Fixed value: the smallest denominator of a percentage error, double machine epsilon.
EPSILON = 2.220446049250313e-16

REGRESSION_METRICS = ("rmse", "mae", "median_ae", "r2", "explained_variance", "mape", "rmsle")
CLASSIFICATION_METRICS = ("accuracy", "precision", "recall", "f1")


def _same_group(left: Sequence[str], prefix: str) -> Column:
    return reduce(and_, [col(b).eqNullSafe(col(f"{prefix}{b}")) for b in left])


def _unexplained(loss: Column, total: Column) -> Column:
    """1 − loss/total, where a constant label scores 1 if it is met exactly and else 0."""
    return F.when(total > 0, 1 - divide(loss, total)).otherwise(F.when(loss == 0, 1.0).otherwise(0.0))


def regression_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = (),
                       with_median: bool = True) -> DataFrame:
    """Error and fit metrics per group; the logarithmic error clips both sides at zero."""
    by = list(by)
    rows = df.select(*[col(b) for b in by], number(label).alias("_y"), number(prediction).alias("_p")).withColumn(
        "_e", F.col("_y") - F.col("_p"))
    y, e = F.col("_y"), F.col("_e")
    log_gap = F.log1p(F.greatest(y, F.lit(0.0))) - F.log1p(F.greatest(F.col("_p"), F.lit(0.0)))
    n = F.count(F.lit(1))
    scores = rows.groupBy(*[col(b) for b in by]).agg(
        n.alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        _unexplained(F.sum(e * e), F.var_pop(y) * n).alias("r2"),
        _unexplained(F.var_pop(e), F.var_pop(y)).alias("explained_variance"),
        F.avg(F.abs(e) / F.greatest(F.abs(y), F.lit(EPSILON))).alias("mape"),
        F.sqrt(F.avg(log_gap * log_gap)).alias("rmsle"),
    )
    if not with_median:
        return scores
    errors = rows.select(*[col(b) for b in by], F.abs(e).alias("_abs"))
    if not by:
        return scores.withColumn("median_ae", F.lit(exact_quantiles(errors, ["_abs"], (0.5,))["_abs"][0]).cast("double"))
    medians = quantiles_by(errors, "_abs", (0.5,), by).select(
        *[col(b).alias(f"_m_{b}") for b in by], F.col("q")[0].alias("median_ae"))
    return scores.join(medians, _same_group(by, "_m_")).drop(*[f"_m_{b}" for b in by])


def confusion_counts(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts of the (label, prediction) pairs that occur."""
    return df.groupBy(*[col(b) for b in by], col(label).alias("label"), col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Counts for every pair of labels, zeros included, per group."""
    counts = confusion_counts(df, label, prediction, by)
    keys = [col(b).alias(f"_g_{b}") for b in by]
    seen = counts.groupBy(*keys).agg(F.array_sort(F.array_union(F.collect_set("label"), F.collect_set("prediction"))).alias("_l"))
    grid = seen.withColumn("_label", F.explode("_l")).withColumn("_prediction", F.explode("_l")).drop("_l")
    match = (F.col("label") == F.col("_label")) & (F.col("prediction") == F.col("_prediction"))
    if by:
        match = match & _same_group(by, "_g_")
    return grid.join(counts, match, "left").select(
        *[col(f"_g_{b}").alias(b) for b in by], F.col("_label").alias("label"), F.col("_prediction").alias("prediction"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def classification_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = (),
                           positive=None, averaged: bool = False) -> DataFrame:
    """Accuracy, precision, recall and F1 per group.

    With two labels in the truth the scores are those of `positive` (the larger label by default),
    else unweighted means over all labels true or predicted.  A zero denominator scores 0.
    `averaged` gives means in any case: a part of a table with more labels may hold two of them.
    """
    counts = confusion_counts(df, label, prediction, by)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("predicted"),
                 hit.alias("tp")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("predicted"),
                 F.lit(0).cast("long").alias("tp")),
    )
    keys = [col(b) for b in by]
    classes = counts.select(*keys, F.inline(sides)).groupBy(*keys, "class").agg(
        F.sum("actual").alias("actual"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))
    scored = classes.withColumns({
        "_precision": divide_or_zero(F.col("tp"), F.col("predicted")),
        "_recall": divide_or_zero(F.col("tp"), F.col("actual")),
        "_f1": divide_or_zero(2 * F.col("tp"), F.col("actual") + F.col("predicted")),
    })
    truth = F.when(F.col("actual") > 0, F.col("class"))
    chosen = F.lit(positive) if positive is not None else F.col("_top")
    if positive is None:
        tops = scored.groupBy(*keys).agg(F.max(truth).alias("_top"))
        if by:
            tops = tops.select(*[col(b).alias(f"_t_{b}") for b in by], "_top")
            scored = scored.join(tops, _same_group(by, "_t_"))
        else:
            scored = scored.withColumn("_top", tops.agg(F.max("_top")).scalar())
    binary = F.lit(False) if averaged else F.count_if(F.col("actual") > 0) == 2
    one = F.col("class") == chosen
    return scored.groupBy(*keys).agg(
        F.sum("actual").alias("n"), divide(F.sum("tp"), F.sum("actual")).alias("accuracy"),
        *[
            F.when(binary, F.coalesce(F.max(F.when(one, F.col(f"_{m}"))), F.lit(0.0))).otherwise(F.avg(f"_{m}")).alias(m)
            for m in ("precision", "recall", "f1")
        ],
    )


def calibration_curve(df: DataFrame, hit: str, score: str, by: Sequence[str] = (), bins: int = 10) -> DataFrame:
    """Mean score and share of hits per equal-width score bin that is not empty.

    A score on an inner edge belongs to the lower bin.
    """
    place = F.lit(0)
    for i in range(1, bins):
        place = place + (number(score) > i * (1.0 / bins)).cast("int")
    return df.groupBy(*[col(b) for b in by], place.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(number(score)).alias("mean_score"), F.avg(number(hit)).alias("hit_rate"))


def residual_diagnostics(df: DataFrame, label: str, prediction: str, keys: Sequence[str] = ()) -> DataFrame:
    """Actual, predicted and residual per row."""
    return df.select(*[col(k) for k in keys], number(label).alias("actual"), number(prediction).alias("predicted")).withColumn(
        "residual", F.col("actual") - F.col("predicted"))
