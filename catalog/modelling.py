"""Model fitting, search, importances, learning curves and the whole workflow."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.preparing import ROUTED, dirty, labelled, routed_frame
from catalog.registry import query, table
from tallyloom.operators import importance, learning, metrics, models, search
from tallyloom.operators.prepare import Preprocessor
from tallyloom.plans import evaluation, workflow
from tallyloom.plans.cleaning import admissions_plan
from tallyloom.session import checkpointed, scratch_path
from tallyloom.sources import sinks


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def item_id():
    """Order and line number repeat in this table; with part, supplier and price in cents they do not."""
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents)


def _prices(spark, sf):
    """Price from quantity: one feature, so SQL has the same line."""
    return table(spark, sf, "lineitem").select(item_id().alias("id"), "l_quantity", "l_discount", "l_tax", "l_extendedprice")


@query("linear_regression", sql="""
SELECT round(regr_slope(l_extendedprice, l_quantity), 5) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept FROM lineitem
""")
def linear_regression(spark, sf):
    rows = _prices(spark, sf).withColumn(models.LABEL, F.col("l_extendedprice"))
    fitted = models.fit_model(models.linear_regression(), {}, rows, ["l_quantity"], rows.count()).stages[-1]
    return spark.createDataFrame([(round(float(fitted.coefficients[0]), 5), round(float(fitted.intercept), 4))], "slope double, intercept double")


@query("non_negative_regression", sql="""
SELECT 'l_quantity' AS feature, round(greatest(regr_slope(l_extendedprice, l_quantity), 0), 5) AS weight FROM lineitem
UNION ALL SELECT 'negative', round(greatest(-regr_slope(l_extendedprice, l_quantity), 0), 5) FROM lineitem
""")
def non_negative_regression(spark, sf):
    """Of a feature and its negative only the one with the positive weight is used, and it carries the line."""
    rows = _prices(spark, sf).withColumns({models.LABEL: F.col("l_extendedprice"), "negative": -F.col("l_quantity")})
    fitted = models.fit_model(models.linear_regression(), {"positive": True}, rows, ["l_quantity", "negative"], 0).stages[-1]
    weights = [round(float(w), 5) for w in fitted.coefficients]
    return spark.createDataFrame(list(zip(["l_quantity", "negative"], weights)), "feature string, weight double")


def _admissions(spark, sf):
    """Prepared readmission rows and their feature names; the clean rows are written once, as every fit reads them."""
    rows = checkpointed(routed_frame(spark, sf).dropDuplicates(["id"]))
    fitted = Preprocessor(ROUTED, keep=["id", "risk_category"]).fit(rows)
    return fitted.transform(rows), fitted.feature_names


def _fit_classifier(candidate, params):
    def run(spark, sf):
        rows, features = _admissions(spark, sf)
        rows = models.with_code(rows, "risk_category", [0, 1])
        model = models.fit_model(candidate, params, rows, features, rows.count())
        out = models.scored(model, rows, ["id"])
        return out.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))

    return run


query("random_forest_classifier")(_fit_classifier(models.random_forest(), {"n_estimators": 10, "max_depth": 5}))
query("logistic_regression")(_fit_classifier(models.logistic_regression(), {"C": 1.0}))


@query("random_forest_regressor")
def random_forest_regressor(spark, sf):
    rows = _prices(spark, sf).withColumn(models.LABEL, F.col("l_extendedprice"))
    model = models.fit_model(models.random_forest_regressor(), {"n_estimators": 5, "max_depth": 4}, rows, ["l_quantity", "l_tax"], 0)
    return metrics.regression_metrics(models.scored(model, rows, ["id"]), models.LABEL, "prediction", with_median=False)


def _report(spark, trained, errors):
    if errors:
        raise RuntimeError(f"training failed: {errors}")
    return search.training_report(spark, trained).drop("seconds", "size_kb", "error")


def _search(kind):
    def run(spark, sf):
        rows, features = _admissions(spark, sf)
        grid = {"C": [0.01, 1.0]}
        candidates = [models.Candidate("LogisticRegression", "classification", models.logistic_regression(20).build, grid, grid)]
        return _report(spark, *search.train_all(
            candidates, rows, "risk_category", features, "id", metric="f1", search_type=kind, folds=3, n_iter=2))

    return run


query("grid_search")(_search("grid"))
query("random_search")(_search("random"))


@query("train_regression_candidates")
def train_regression_candidates(spark, sf):
    return _report(spark, *search.train_all(
        [models.linear_regression()], _prices(spark, sf), "l_extendedprice", ["l_quantity", "l_tax"], "id", task="regression",
        metric="r2", folds=3))


def _cannot_fit(params, rows, seed):
    raise ValueError("this candidate cannot be fitted")


@query("training_report_with_failure", sql="""
SELECT 'Broken' AS model, TRUE AS failed, CAST(0 AS BIGINT) AS choices UNION ALL SELECT 'LinearRegression', FALSE, 4
""")
def training_report_with_failure(spark, sf):
    """A candidate that fails keeps its row, and does not stop the others."""
    broken = models.Candidate("Broken", "regression", _cannot_fit, {}, {})
    trained, errors = search.train_all(
        [broken, models.linear_regression()], _prices(spark, sf), "l_extendedprice", ["l_quantity", "l_tax"], "id",
        task="regression", metric="r2", folds=2)
    report = search.training_report(spark, trained, errors)
    return report.groupBy("model", F.col("error").isNotNull().alias("failed")).agg(F.count("params").alias("choices"))


@query("search_with_resampling")
def search_with_resampling(spark, sf):
    rows = labelled(spark, sf)
    return _report(spark, *search.train_all(
        [models.logistic_regression(20)], rows, "quality", ["x", "y", "z"], "doc_id", metric="f1", folds=2, resampling="SMOTE",
        parallelism=1))


@query("save_model", sql='SELECT count(*) AS equal, count(*) AS "rows", TRUE AS has_size FROM lineitem')
def save_model(spark, sf):
    """Store a model, read it back, and count the rows both predict alike."""
    from pyspark.ml import PipelineModel

    rows = _prices(spark, sf).withColumn(models.LABEL, F.col("l_extendedprice"))
    model = models.fit_model(models.linear_regression(), {}, rows, ["l_quantity", "l_tax"], 0)
    path = scratch_path(spark, "model")
    size = sinks.save_model(spark, model, path)
    again = PipelineModel.load(path).transform(rows).select("id", F.col("prediction").alias("again"))
    both = model.transform(rows).select("id", "prediction").join(again, "id")
    return both.agg(F.count_if(F.col("prediction") == F.col("again")).alias("equal"), F.count(F.lit(1)).alias("rows")).withColumn(
        "has_size", F.lit(size > 0))


@query("coefficient_importance_of_one", sql="""
SELECT 'LinearRegression' AS model, 'l_quantity' AS feature, round(abs(regr_slope(l_extendedprice, l_quantity)), 4) AS importance FROM lineitem
""")
def coefficient_importance_of_one(spark, sf):
    """The weight of a model's only feature is the slope of the line."""
    rows = _prices(spark, sf).withColumn(models.LABEL, F.col("l_extendedprice"))
    model = models.fit_model(models.linear_regression(), {}, rows, ["l_quantity"], 0)
    return rounded(importance.model_importances(spark, model, ["l_quantity"], "LinearRegression"), "importance", digits=4)


@query("logistic_regression_balance", sql="""
SELECT CAST(0 AS DOUBLE) AS gap, count(*) AS n FROM lineitem
""")
def logistic_regression_balance(spark, sf):
    """The intercept is not penalised: the mean probability is the share of the label."""
    rows = _prices(spark, sf).withColumn(models.LABEL, (F.col("l_tax") > 0.04).cast("double"))
    model = models.fit_model(models.logistic_regression(), {"C": 1.0}, rows, ["l_quantity", "l_extendedprice"], rows.count())
    out = models.scored(model, rows, [])
    gap = F.avg(F.col("probability")[1]) - F.avg(models.LABEL)
    return out.agg(F.abs(F.round(gap, 4)).alias("gap"), F.count(F.lit(1)).alias("n"))


@query("permutation_importance_of_a_constant", sql="""
SELECT 'steady' AS feature, CAST(0 AS DOUBLE) AS importance, CAST(0 AS DOUBLE) AS deviation, count(*) > 0 AS read FROM lineitem
""")
def permutation_importance_of_a_constant(spark, sf):
    """Shuffling a feature that is the same everywhere changes nothing."""
    rows = _prices(spark, sf).withColumns({"steady": F.lit(1.0), models.LABEL: F.col("l_extendedprice")})
    model = models.fit_model(models.linear_regression(), {}, rows, ["l_quantity", "steady"], 0)
    out = importance.permutation_importance(
        rows, model.transform, lambda df, by: search.score_table(df, "r2", by), ["l_quantity", "steady"], "id", repeats=2)
    return rounded(out.filter("feature = 'steady'"), "importance", "deviation").withColumn("read", F.lit(True))


@query("coefficient_importance")
def coefficient_importance(spark, sf):
    rows, features = _admissions(spark, sf)
    model = models.fit_model(models.logistic_regression(20), {}, models.with_code(rows, "risk_category", [0, 1]), features, rows.count())
    return importance.model_importances(spark, model, features, "LogisticRegression")


@query("tree_importance")
def tree_importance(spark, sf):
    rows, features = _admissions(spark, sf)
    model = models.fit_model(models.random_forest(), {"n_estimators": 10, "max_depth": 4},
                             models.with_code(rows, "risk_category", [0, 1]), features, 0)
    return importance.model_importances(spark, model, features, "RandomForest")


@query("write_importances")
def write_importances(spark, sf):
    path = scratch_path(spark, "importances")
    sinks.write_importances(tree_importance(spark, sf), path)
    return spark.read.option("header", True).schema("model string, feature string, importance double").csv(path)


_WEIGHTS = {"l_quantity": 2.0, "l_discount": 100.0, "l_tax": -50.0}
_SCORE = " + ".join(f"{w} * {{{c}}}" for c, w in _WEIGHTS.items())
_REPEATS = 3


def _permuted(feature):
    cells = {c: f"{'d' if c == feature else 'a'}.{c}" for c in _WEIGHTS}
    return f"""SELECT '{feature}' AS feature, rep, 1 - sum((a.y - ({_SCORE.format(**cells)})) ^ 2) / (var_pop(a.y) * count(*)) AS score
FROM p a JOIN w ON a.bucket = w.bucket AND a.i = w.i JOIN p d ON d.bucket = w.bucket AND d.i = w.want GROUP BY rep"""


@query("permutation_importance", sql=f"""
WITH r AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT)) AS id, l_quantity, l_discount, l_tax, 2 * l_quantity + 90 * l_discount - 10 * l_tax + l_linenumber AS y FROM lineitem),
b AS (SELECT *, ('0x' || substr(md5(id || ':42:bucket'), 1, 13))::BIGINT % 16 AS bucket,
             ('0x' || substr(md5(id || ':42'), 1, 13))::BIGINT AS h FROM r),
p AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY h) - 1 AS i, count(*) OVER (PARTITION BY bucket) AS size FROM b),
w AS (SELECT bucket, i, rep, (i + 1 + ('0x' || substr(md5(bucket || ':' || rep || ':42'), 1, 13))::BIGINT % (size - 1)) % size AS want
      FROM p, range({_REPEATS}) t(rep)),
base AS (SELECT 1 - sum((y - ({_SCORE.format(**{c: c for c in _WEIGHTS})})) ^ 2) / (var_pop(y) * count(*)) AS s FROM r),
t AS ({" UNION ALL ".join(_permuted(c) for c in _WEIGHTS)})
SELECT feature, round(avg(s - score), 6) AS importance, round(stddev_pop(s - score), 6) AS deviation FROM t, base GROUP BY feature
""")
def permutation_importance(spark, sf):
    """A fixed linear score in place of a model, so that SQL can shuffle the same way."""
    label = 2 * F.col("l_quantity") + 90 * F.col("l_discount") - 10 * F.col("l_tax") + F.col("l_linenumber")
    rows = table(spark, sf, "lineitem").select(
        item_id().alias("id"), *_WEIGHTS, label.alias(models.LABEL))

    def predict(df):
        return df.withColumn("prediction", sum((w * F.col(c) for c, w in _WEIGHTS.items()), F.lit(0.0)))

    out = importance.permutation_importance(
        rows, predict, lambda df, by: search.score_table(df, "r2", by), list(_WEIGHTS), "id", repeats=_REPEATS, buckets=16)
    return rounded(out, "importance", "deviation")


@query("permutation_importance_of_model")
def permutation_importance_of_model(spark, sf):
    rows, features = _admissions(spark, sf)
    rows = models.with_code(rows, "risk_category", [0, 1])
    model = models.fit_model(models.logistic_regression(20), {}, rows, features, rows.count())
    return importance.permutation_importance(
        rows, model.transform, lambda df, by: search.score_table(df, "accuracy", by), features, "id", repeats=2)


@query("learning_curve")
def learning_curve(spark, sf):
    rows, features = _admissions(spark, sf)
    return learning.learning_curve(models.logistic_regression(10), {}, rows, "risk_category", features, "id", sizes=(0.25, 0.5, 1.0), folds=3)


@query("evaluate_models")
def evaluate_models(spark, sf):
    """Two classifiers, trained and judged on train and test rows."""
    raw = dirty(spark, sf).withColumn("id", F.col("unnamed_0")).dropDuplicates(["id"])
    settings = workflow.Settings("risk_category", "id", metric="f1", folds=2, stratify=True, learning_sizes=())
    forest = models.Candidate("RandomForest", "classification", models.random_forest().build, {"n_estimators": [10], "max_depth": [4]})
    done = workflow.run(raw, settings, [models.logistic_regression(20), forest], admissions_plan(), Preprocessor(ROUTED))
    return rounded(done.metrics, "accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")


@query("evaluate_regressors")
def evaluate_regressors(spark, sf):
    rows = _prices(spark, sf).drop("l_discount")
    settings = workflow.Settings("l_extendedprice", "id", task="regression", metric="r2", folds=2, learning_sizes=())
    done = workflow.run(rows, settings, [models.linear_regression()])
    return evaluation.summary(done.metrics, "regression")


def _halves(spark, sf, label):
    half = (F.col("l_linenumber") % 2).cast("double")
    return table(spark, sf, "lineitem").select(item_id().alias("id"), half.alias("half"), F.expr(label).cast("double").alias(models.LABEL))


_ONE_TREE = {"n_estimators": 1, "max_depth": 1, "min_samples_split": 2}


@query("random_forest_of_one_tree", sql="""
SELECT CAST(l_linenumber % 2 AS DOUBLE) AS half, CAST(7 + 5 * (l_linenumber % 2) AS DOUBLE) AS prediction, count(*) AS n FROM lineitem GROUP BY 1, 2
""")
def random_forest_of_one_tree(spark, sf):
    """A tree of one split finds two groups that differ by nothing else, whatever rows it was drawn."""
    rows = _halves(spark, sf, "7 + 5 * (l_linenumber % 2)")
    model = models.fit_model(models.random_forest_regressor(), _ONE_TREE, rows, ["half"], 0)
    out = models.scored(model, rows, ["half"]).groupBy("half").agg(F.avg("prediction").alias("prediction"), F.count(F.lit(1)).alias("n"))
    return rounded(out, "prediction")


@query("random_forest_classifier_of_one_tree", sql="""
SELECT CAST(l_linenumber % 2 AS DOUBLE) AS half, CAST(1 - l_linenumber % 2 AS DOUBLE) AS probability, count(*) AS n FROM lineitem GROUP BY 1, 2
""")
def random_forest_classifier_of_one_tree(spark, sf):
    """Its probabilities are the labels, where the label is one feature's opposite."""
    rows = _halves(spark, sf, "l_linenumber % 2 = 0")
    model = models.fit_model(models.random_forest(), _ONE_TREE, rows, ["half"], 0)
    out = models.scored(model, rows, ["half"]).groupBy("half").agg(
        F.avg(F.col("probability")[1]).alias("probability"), F.count(F.lit(1)).alias("n"))
    return rounded(out, "probability")


@query("tree_importance_of_one", sql="SELECT 'RandomForest' AS model, 'half' AS feature, CAST(1 AS DOUBLE) AS importance, count(*) > 0 AS read FROM lineitem")
def tree_importance_of_one(spark, sf):
    """All gain is that of the only feature; the table goes through the sink and back."""
    rows = _halves(spark, sf, "l_quantity")
    model = models.fit_model(models.random_forest_regressor(), _ONE_TREE, rows, ["half"], 0)
    path = scratch_path(spark, "importances")
    sinks.write_importances(importance.model_importances(spark, model, ["half"], "RandomForest"), path)
    stored = spark.read.option("header", True).schema("model string, feature string, importance double").csv(path)
    return stored.withColumn("read", F.lit(True))


def _line(spark, sf):
    """A label that is an exact line of one feature: every part of the rows gives the same fit."""
    return _prices(spark, sf).select("id", "l_quantity", (2 * F.col("l_quantity") + 3).alias("y"))


@query("search_of_a_line", sql="""
SELECT kind, 'LinearRegression' AS model, CAST(4 AS BIGINT) AS choices, CAST(1 AS BIGINT) AS best, CAST(1 AS DOUBLE) AS score, count(*) > 0 AS read
FROM lineitem, (VALUES ('grid'), ('random')) t(kind) GROUP BY kind
""")
def search_of_a_line(spark, sf):
    """Both searches try all four choices; the held-out folds of an exact line score 1."""
    parts = []
    for kind in ("grid", "random"):
        found = _report(spark, *search.train_all(
            [models.linear_regression()], _line(spark, sf), "y", ["l_quantity"], "id", task="regression", metric="r2", search_type=kind,
            folds=3, n_iter=4))
        parts.append(found.groupBy("model").agg(
            F.count(F.lit(1)).alias("choices"), F.count_if("is_best").alias("best"), F.round(F.max("cv_score"), 4).alias("score"),
        ).withColumns({"kind": F.lit(kind), "read": F.lit(True)}))
    return parts[0].unionByName(parts[1])


@query("learning_curve_of_a_line", sql="""
WITH n AS (SELECT count(*) AS n FROM lineitem), f AS (SELECT n - n // 3 - CASE WHEN i < n % 3 THEN 1 ELSE 0 END AS train FROM n, range(0, 3) t(i))
SELECT size, CAST(min(greatest(CAST(floor(size * train) AS BIGINT), 1)) AS DOUBLE) AS "rows", CAST(1 AS DOUBLE) AS train_mean,
       CAST(0 AS DOUBLE) AS train_std, CAST(1 AS DOUBLE) AS valid_mean, CAST(0 AS DOUBLE) AS valid_std
FROM f, (VALUES (CAST(0.25 AS DOUBLE)), (CAST(0.5 AS DOUBLE)), (CAST(1 AS DOUBLE))) s(size) GROUP BY size
""")
def learning_curve_of_a_line(spark, sf):
    """Sizes of the parts, and scores of 1 on all of them."""
    out = learning.learning_curve(models.linear_regression(), {}, _line(spark, sf), "y", ["l_quantity"], "id", "r2", (0.25, 0.5, 1.0), 3)
    return rounded(out, "train_mean", "train_std", "valid_mean", "valid_std", digits=4).withColumn("rows", F.col("rows").cast("double"))
