"""Metrics, curves and diagnostics on scored tables that need no model."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import (
    BINARY, MULTICLASS, REGRESSION, binary_scores, multiclass_scores, query, regression_scores, table,
)
from tallyloom.operators import curves, metrics, profile
from tallyloom.operators.models import LABEL
from tallyloom.plans import evaluation

CLASS_SCORES = {"A": "score_a", "N": "score_n", "R": "score_r"}


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


_REGRESSION_SQL = """
SELECT {keys} CAST(count(*) AS BIGINT) AS n, round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae,
       round(quantile_cont(abs(e), 0.5), 4) AS median_ae, round(1 - sum(e * e) / (var_pop(y) * count(*)), 6) AS r2,
       round(1 - var_pop(e) / var_pop(y), 6) AS explained_variance,
       round(avg(abs(e) / greatest(abs(y), 2.220446049250313e-16)), 6) AS mape,
       round(sqrt(avg((ln(1 + greatest(y, 0)) - ln(1 + greatest(p, 0))) ^ 2)), 6) AS rmsle
"""


@query("regression_metrics", sql=f"WITH s AS ({REGRESSION}), e AS (SELECT split, actual AS y, predicted AS p, actual - predicted AS e FROM s)"
       + _REGRESSION_SQL.format(keys="split,") + "FROM e GROUP BY split")
def regression_metrics(spark, sf):
    out = metrics.regression_metrics(regression_scores(spark, sf), "actual", "predicted", ["split"])
    return rounded(rounded(out, "rmse", "mae", "median_ae", digits=4), "r2", "explained_variance", "mape", "rmsle")


@query("regression_metrics_with_negatives",
       sql="WITH e AS (SELECT c_acctbal AS y, c_nationkey * 300.0 AS p, c_acctbal - c_nationkey * 300.0 AS e FROM customer)"
       + _REGRESSION_SQL.format(keys="") + "FROM e")
def regression_metrics_with_negatives(spark, sf):
    rows = table(spark, sf, "customer").withColumn("guess", F.col("c_nationkey") * 300.0)
    out = metrics.regression_metrics(rows, "c_acctbal", "guess")
    return rounded(rounded(out, "rmse", "mae", "median_ae", digits=4), "r2", "explained_variance", "mape", "rmsle")


@query("confusion_matrix", sql=f"""
WITH s AS ({MULTICLASS}), l AS (SELECT DISTINCT label FROM s UNION SELECT DISTINCT prediction FROM s)
SELECT a.label, b.label AS prediction, CAST((SELECT count(*) FROM s WHERE s.label = a.label AND s.prediction = b.label) AS BIGINT) AS n
FROM l a, l b
""")
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(multiclass_scores(spark, sf), "label", "prediction")


_CLASS_STATS = """
l AS (SELECT split, label AS c FROM s UNION SELECT split, prediction FROM s),
k AS (SELECT l.split, l.c, count(*) FILTER (WHERE s.label = l.c AND s.prediction = l.c) AS tp,
             count(*) FILTER (WHERE s.label = l.c) AS actual, count(*) FILTER (WHERE s.prediction = l.c) AS predicted
      FROM l JOIN s ON l.split = s.split GROUP BY 1, 2),
m AS (SELECT split, c, tp, actual, predicted, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS p,
             CASE WHEN actual > 0 THEN tp / actual ELSE 0 END AS r,
             CASE WHEN actual + predicted > 0 THEN 2 * tp / (actual + predicted) ELSE 0 END AS f FROM k)
"""


@query("classification_metrics_binary", sql=f"""
WITH s AS (SELECT split, hit AS label, CAST(score >= 0.45 AS INT) AS prediction FROM ({BINARY})), {_CLASS_STATS}
SELECT split, CAST(sum(actual) AS BIGINT) AS n, round(sum(tp) / sum(actual), 6) AS accuracy, round(max(p) FILTER (WHERE c = 1), 6) AS "precision",
       round(max(r) FILTER (WHERE c = 1), 6) AS recall, round(max(f) FILTER (WHERE c = 1), 6) AS f1 FROM m GROUP BY split
""")
def classification_metrics_binary(spark, sf):
    scored = curves.apply_threshold(binary_scores(spark, sf), "score", 0.45)
    out = metrics.classification_metrics(scored, "hit", "prediction", ["split"])
    return rounded(out, "accuracy", "precision", "recall", "f1")


@query("classification_metrics_multiclass", sql=f"""
WITH s AS (SELECT split, label, prediction FROM ({MULTICLASS})), {_CLASS_STATS}
SELECT split, CAST(sum(actual) AS BIGINT) AS n, round(sum(tp) / sum(actual), 6) AS accuracy, round(avg(p), 6) AS "precision",
       round(avg(r), 6) AS recall, round(avg(f), 6) AS f1 FROM m GROUP BY split
""")
def classification_metrics_multiclass(spark, sf):
    out = metrics.classification_metrics(multiclass_scores(spark, sf), "label", "prediction", ["split"])
    return rounded(out, "accuracy", "precision", "recall", "f1")


# Running counts from the highest score down, per class, over the rows of `long(class, score, hit)`.
_CUMULATED = """
g AS (SELECT class, score, sum(hit) AS pos, sum(1 - hit) AS neg FROM long GROUP BY 1, 2),
c AS (SELECT class, score, pos, neg, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY class) AS p,
             sum(neg) OVER (PARTITION BY class) AS n, lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg,
             lag(score) OVER w AS higher
      FROM g WINDOW w AS (PARTITION BY class ORDER BY score DESC))
"""
_LONG_BINARY = f"long AS (SELECT 1 AS class, score, hit FROM ({BINARY}))"
_LONG_CLASSES = f"""s AS ({MULTICLASS}),
long AS (SELECT 'A' AS class, score_a AS score, CAST(label = 'A' AS INT) AS hit FROM s
         UNION ALL SELECT 'N', score_n, CAST(label = 'N' AS INT) FROM s
         UNION ALL SELECT 'R', score_r, CAST(label = 'R' AS INT) FROM s)"""
_AREAS = """
a AS (SELECT class, max(p) AS positives, max(n) AS negatives, sum(neg / n * (tp / p + (tp - pos) / p) / 2) AS roc_auc,
      sum(pos / p * (tp / (tp + fp) + CASE WHEN higher IS NULL THEN 1 ELSE (tp - pos) / (tp - pos + fp - neg) END) / 2) AS pr_auc
      FROM c GROUP BY class)
"""
_KEPT = "higher IS NULL OR next_pos IS NULL OR pos <> next_pos OR neg <> next_neg"


@query("best_threshold", sql=f"""
WITH long AS (SELECT 1 AS class, score, hit FROM ({BINARY}) WHERE split = 'train'), {_CUMULATED},
f AS (SELECT score, tp / (tp + fp) AS pr, tp / p AS re FROM c), o AS (SELECT *, 2 * pr * re / (pr + re + 1e-8) AS f1 FROM f)
SELECT score AS threshold, round(f1, 6) AS f1, round(pr, 6) AS "precision", round(re, 6) AS recall FROM o ORDER BY o.f1 DESC, score LIMIT 1
""")
def best_threshold(spark, sf):
    train = binary_scores(spark, sf).filter("split = 'train'")
    return rounded(curves.best_threshold(train, "hit", "score"), "f1", "precision", "recall")


@query("best_threshold_with_floor", sql=f"""
WITH long AS (SELECT split AS class, score, hit FROM ({BINARY})), {_CUMULATED},
f AS (SELECT class, score, tp / (tp + fp) AS pr, tp / p AS re FROM c), o AS (SELECT *, 2 * pr * re / (pr + re + 1e-8) AS f1 FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY f1 DESC, score) AS rn FROM o WHERE pr >= 0.4999 AND re >= 0.2)
SELECT k.class AS split, coalesce(score, 0.5) AS threshold, round(coalesce(f1, 0), 6) AS f1, round(pr, 6) AS "precision", round(re, 6) AS recall
FROM (SELECT DISTINCT class FROM long) k LEFT JOIN r ON r.class = k.class AND rn = 1
""")
def best_threshold_with_floor(spark, sf):
    out = curves.best_threshold(binary_scores(spark, sf), "hit", "score", ["split"], minimum_precision=0.4999, minimum_recall=0.2)
    return rounded(out, "f1", "precision", "recall")


@query("roc_curve", sql=f"""
WITH {_LONG_BINARY}, {_CUMULATED}
SELECT score AS threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM c WHERE {_KEPT}
UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0
""")
def roc_curve(spark, sf):
    return rounded(curves.roc_curve(binary_scores(spark, sf), "hit", "score"), "fpr", "tpr")


@query("pr_curve", sql=f"""
WITH {_LONG_BINARY}, {_CUMULATED}
SELECT score AS threshold, round(tp / p, 6) AS recall, round(tp / (tp + fp), 6) AS "precision" FROM c
UNION ALL SELECT NULL, 0.0, 1.0
""")
def pr_curve(spark, sf):
    return rounded(curves.pr_curve(binary_scores(spark, sf), "hit", "score"), "recall", "precision")


@query("curve_areas", sql=f"""
WITH long AS (SELECT split AS class, score, hit FROM ({BINARY})), {_CUMULATED}, {_AREAS}
SELECT class AS split, CAST(positives AS BIGINT) AS positives, CAST(negatives AS BIGINT) AS negatives, round(roc_auc, 6) AS roc_auc,
       round(pr_auc, 6) AS pr_auc FROM a
""")
def curve_areas(spark, sf):
    return rounded(curves.curve_areas(binary_scores(spark, sf), "hit", "score", ["split"]), "roc_auc", "pr_auc")


@query("roc_curve_many_scores", sql=f"""
WITH long AS (SELECT 1 AS class, l_extendedprice AS score, CAST(l_linestatus = 'F' AS INT) AS hit FROM lineitem), {_CUMULATED}
SELECT score AS threshold, round(fp / n, 6) AS fpr, round(tp / p, 6) AS tpr FROM c WHERE {_KEPT}
UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0
""")
def roc_curve_many_scores(spark, sf):
    """Nearly every row has its own score: the case the score buckets are for."""
    rows = table(spark, sf, "lineitem").select((F.col("l_linestatus") == "F").cast("int").alias("hit"), "l_extendedprice")
    return rounded(curves.roc_curve(rows, "hit", "l_extendedprice"), "fpr", "tpr")


@query("macro_areas", sql=f"""
WITH {_LONG_CLASSES}, {_CUMULATED}, {_AREAS}
SELECT CAST(count(*) AS BIGINT) AS classes, round(avg(roc_auc), 6) AS macro_roc_auc, round(avg(pr_auc), 6) AS macro_pr_auc FROM a
""")
def macro_areas(spark, sf):
    return rounded(curves.macro_areas(multiclass_scores(spark, sf), "label", CLASS_SCORES), "macro_roc_auc", "macro_pr_auc")


def _mean_curve(points, entry, leave):
    """Curve of mean heights over all x, by joins to the neighbouring points of each class."""
    return f"""
WITH {_LONG_CLASSES}, {_CUMULATED},
k AS ({points}), u AS (SELECT class, x, {entry}(y) AS entry, {leave}(y) AS leave FROM k GROUP BY 1, 2),
x AS (SELECT DISTINCT x FROM u), cl AS (SELECT DISTINCT class FROM u),
j AS (SELECT x.x, cl.class, u.leave AS here FROM x CROSS JOIN cl LEFT JOIN u ON u.x = x.x AND u.class = cl.class),
z AS (SELECT j.x, j.class, j.here, l.x AS lx, l.leave AS ly, r.x AS rx, r.entry AS ry
      FROM j ASOF LEFT JOIN u l ON j.class = l.class AND j.x >= l.x ASOF LEFT JOIN u r ON j.class = r.class AND j.x <= r.x),
m AS (SELECT x, avg(coalesce(here, ly + (ry - ly) / (rx - lx) * (x - lx))) AS y FROM z GROUP BY x)"""


_ROC_POINTS = f"SELECT class, fp / n AS x, tp / p AS y FROM c WHERE {_KEPT} UNION ALL SELECT DISTINCT class, 0.0, 0.0 FROM c"
_PR_POINTS = "SELECT class, tp / p AS x, tp / (tp + fp) AS y FROM c UNION ALL SELECT DISTINCT class, 0.0, 1.0 FROM c"
_AREA = "SELECT round(sum((x - px) * (y + py) / 2), 6) AS area FROM (SELECT x, y, lag(x) OVER (ORDER BY x) AS px, lag(y) OVER (ORDER BY x) AS py FROM m)"


@query("mean_roc_curve", sql=_mean_curve(_ROC_POINTS, "min", "max") + "SELECT round(x, 6) AS x, round(y, 6) AS y FROM m")
def mean_roc_curve(spark, sf):
    return rounded(curves.mean_curve(multiclass_scores(spark, sf), "label", CLASS_SCORES, "roc"), "x", "y")


@query("mean_pr_curve", sql=_mean_curve(_PR_POINTS, "max", "min") + "SELECT round(x, 6) AS x, round(y, 6) AS y FROM m")
def mean_pr_curve(spark, sf):
    return rounded(curves.mean_curve(multiclass_scores(spark, sf), "label", CLASS_SCORES, "pr"), "x", "y")


@query("mean_roc_area", sql=_mean_curve(_ROC_POINTS, "min", "max") + _AREA)
def mean_roc_area(spark, sf):
    return rounded(curves.curve_area(curves.mean_curve(multiclass_scores(spark, sf), "label", CLASS_SCORES, "roc")), "area")


@query("mean_pr_area", sql=_mean_curve(_PR_POINTS, "max", "min") + _AREA)
def mean_pr_area(spark, sf):
    return rounded(curves.curve_area(curves.mean_curve(multiclass_scores(spark, sf), "label", CLASS_SCORES, "pr")), "area")


_BIN = " + ".join(f"CAST(score > {i} * CAST(0.1 AS DOUBLE) AS INT)" for i in range(1, 10))


@query("calibration_curve", sql=f"""
SELECT {_BIN} AS bin, CAST(count(*) AS BIGINT) AS n, round(avg(score), 6) AS mean_score, round(avg(hit), 6) AS hit_rate
FROM ({BINARY}) GROUP BY 1
""")
def calibration_curve(spark, sf):
    return rounded(metrics.calibration_curve(binary_scores(spark, sf), "hit", "score"), "mean_score", "hit_rate")


@query("calibration_by_class", sql=f"""
WITH {_LONG_CLASSES}
SELECT class, {_BIN} AS bin, CAST(count(*) AS BIGINT) AS n, round(avg(score), 6) AS mean_score, round(avg(hit), 6) AS hit_rate
FROM long GROUP BY 1, 2
""")
def calibration_by_class(spark, sf):
    long = curves.one_vs_rest(multiclass_scores(spark, sf), "label", CLASS_SCORES)
    return rounded(metrics.calibration_curve(long, "hit", "score", ["class"]), "mean_score", "hit_rate")


@query("residual_diagnostics", sql=f"""
SELECT l_orderkey, l_linenumber, actual, predicted, round(actual - predicted, 4) AS residual FROM ({REGRESSION})
""")
def residual_diagnostics(spark, sf):
    out = metrics.residual_diagnostics(regression_scores(spark, sf), "actual", "predicted", ["l_orderkey", "l_linenumber"])
    return rounded(out, "residual", digits=4)


@query("residual_histogram", sql=f"""
WITH r AS (SELECT actual - predicted AS v FROM ({REGRESSION})), s AS (SELECT min(v) AS lo, max(v) AS hi FROM r),
c AS (SELECT least(CAST(floor((v - lo) / (hi - lo) * 30) AS BIGINT), 29) AS bin, count(*) AS n FROM r, s GROUP BY 1)
SELECT CAST(g.i AS BIGINT) AS bin, round(lo + g.i * ((hi - lo) / 30), 4) AS lower, round(lo + (g.i + 1) * ((hi - lo) / 30), 4) AS upper,
       CAST(coalesce(n, 0) AS BIGINT) AS n
FROM range(30) g(i) CROSS JOIN s LEFT JOIN c ON c.bin = g.i
""")
def residual_histogram(spark, sf):
    rows = metrics.residual_diagnostics(regression_scores(spark, sf), "actual", "predicted")
    return rounded(profile.histogram(rows, "residual"), "lower", "upper", digits=4)


def _scored_classes(spark, sf):
    """The three-class table as evaluation has it: labels and predictions are places of sorted classes."""
    code = F.create_map(*[x for i, c in enumerate("ANR") for x in (F.lit(c), F.lit(float(i)))])
    return multiclass_scores(spark, sf).select(
        F.lit("fixed").alias("model"), "split", code[F.col("label")].alias(LABEL), code[F.col("prediction")].alias("prediction"),
        F.array("score_a", "score_n", "score_r").alias("probability"))


_CODED = f"""s AS (
  SELECT 'fixed' AS model, split, CAST(instr('ANR', label) - 1 AS DOUBLE) AS label, CAST(instr('ANR', prediction) - 1 AS DOUBLE) AS prediction,
         score_a, score_n, score_r FROM ({MULTICLASS}))"""


@query("evaluation_confusion", sql=f"""
WITH {_CODED}, l AS (SELECT DISTINCT split, label AS c FROM s UNION SELECT DISTINCT split, prediction FROM s)
SELECT 'fixed' AS model, a.split, a.c AS label, b.c AS prediction,
       CAST((SELECT count(*) FROM s WHERE s.split = a.split AND s.label = a.c AND s.prediction = b.c) AS BIGINT) AS n
FROM l a JOIN l b ON a.split = b.split
""")
def evaluation_confusion(spark, sf):
    return evaluation.classification_tables(_scored_classes(spark, sf), 3)["confusion"]


@query("evaluation_calibration", sql=f"""
WITH {_CODED}, long AS (
  SELECT model, split, c AS class, score, CAST(label = c AS INT) AS hit FROM (
    SELECT model, split, label, 0 AS c, score_a AS score FROM s UNION ALL SELECT model, split, label, 1, score_n FROM s
    UNION ALL SELECT model, split, label, 2, score_r FROM s))
SELECT model, split, class, {_BIN} AS bin, CAST(count(*) AS BIGINT) AS n, round(avg(score), 6) AS mean_score, round(avg(hit), 6) AS hit_rate
FROM long GROUP BY 1, 2, 3, 4
""")
def evaluation_calibration(spark, sf):
    return rounded(evaluation.classification_tables(_scored_classes(spark, sf), 3)["calibration"], "mean_score", "hit_rate")


@query("evaluation_residual_bins", sql=f"""
WITH r AS (SELECT split, actual - predicted AS v FROM ({REGRESSION})), e AS (SELECT min(v) AS lo, max(v) AS hi FROM r)
SELECT 'fixed' AS model, split, least(CAST(floor((v - lo) / ((hi - lo) / 30)) AS BIGINT), 29) AS bin, CAST(count(*) AS BIGINT) AS n
FROM r, e GROUP BY 2, 3
""")
def evaluation_residual_bins(spark, sf):
    rows = regression_scores(spark, sf).select(
        F.lit("fixed").alias("model"), "split", F.col("actual").alias(LABEL), F.col("predicted").alias("prediction"))
    return evaluation.regression_tables(rows)["residual_bins"]
