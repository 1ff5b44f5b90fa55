from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import curves, importance, learning, metrics, models, search
from tallyloom.operators.prepare import Preprocessor
from tallyloom.plans import evaluation, workflow


def scored(spark, rows, types="hit int, score double"):
    return spark.createDataFrame(rows, types)


def test_areas_of_opposite_scores_sum_to_one(spark):
    rng = np.random.default_rng(0)
    rows = [(int(rng.random() < 0.3), float(np.round(rng.random(), 1))) for _ in range(400)]
    df = scored(spark, rows)
    up = curves.curve_areas(df, "hit", "score").first()["roc_auc"]
    down = curves.curve_areas(df.withColumn("score", -F.col("score")), "hit", "score").first()["roc_auc"]
    assert up + down == pytest.approx(1.0)


def test_perfect_score(spark):
    df = scored(spark, [(0, 0.1), (0, 0.2), (1, 0.8), (1, 0.9)])
    row = curves.curve_areas(df, "hit", "score").first()
    assert (row["roc_auc"], row["pr_auc"]) == (1.0, 1.0)
    assert curves.best_threshold(df, "hit", "score").first()["threshold"] == 0.8


def test_threshold_ties_and_default(spark):
    """Both 0.4 and 0.6 catch everything they can equally well: the lower one is taken."""
    df = scored(spark, [(1, 0.6), (0, 0.5), (1, 0.4), (0, 0.3), (0, 0.3)])
    best = curves.best_threshold(df, "hit", "score").first()
    assert best["threshold"] == 0.4
    assert curves.best_threshold(scored(spark, [(0, 0.2), (0, 0.9)]), "hit", "score").first()["threshold"] == 0.5
    floored = curves.best_threshold(df, "hit", "score", minimum_precision=0.9).first()
    assert floored["threshold"] == 0.6


def test_roc_leaves_out_points_between_equal_steps(spark):
    df = scored(spark, [(1, 0.9), (1, 0.8), (1, 0.7), (0, 0.6), (0, 0.5), (0, 0.4)])
    kept = {r["threshold"] for r in curves.roc_curve(df, "hit", "score").collect()}
    assert kept == {math.inf, 0.9, 0.7, 0.4}
    assert curves.roc_curve(df, "hit", "score", drop_intermediate=False).count() == 7


def test_no_positive_label(spark):
    row = curves.curve_areas(scored(spark, [(0, 0.1), (0, 0.7)]), "hit", "score").first()
    assert row["roc_auc"] is None


def test_binary_and_macro_scores(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (1, 0)], "y int, p int")
    row = metrics.classification_metrics(df, "y", "p").first()
    assert (row["accuracy"], row["precision"], row["recall"]) == (0.6, 2 / 3, 2 / 3)
    three = spark.createDataFrame([("a", "a"), ("b", "c"), ("c", "c"), ("c", "d")], "y string, p string")
    row = metrics.classification_metrics(three, "y", "p").first()
    assert row["precision"] == pytest.approx((1 + 0 + 0.5 + 0) / 4) and row["recall"] == pytest.approx((1 + 0 + 0.5 + 0) / 4)


def test_nothing_predicted_positive_scores_zero(spark):
    row = metrics.classification_metrics(spark.createDataFrame([(0, 0), (1, 0)], "y int, p int"), "y", "p").first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)


def test_confusion_matrix_has_all_cells(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b")], "y string, p string")
    got = {(r["label"], r["prediction"]): r["n"] for r in metrics.confusion_matrix(df, "y", "p").collect()}
    assert got == {("a", "a"): 1, ("a", "b"): 1, ("b", "a"): 0, ("b", "b"): 0}


def test_regression_metrics_of_a_constant(spark):
    exact = metrics.regression_metrics(spark.createDataFrame([(2.0, 2.0)] * 3, "y double, p double"), "y", "p").first()
    assert (exact["r2"], exact["rmse"]) == (1.0, 0.0)
    off = metrics.regression_metrics(spark.createDataFrame([(0.0, 1.0)] * 3, "y double, p double"), "y", "p").first()
    assert off["r2"] == 0.0 and off["mape"] > 1e15


def test_calibration_edges(spark):
    df = scored(spark, [(1, 0.0), (0, 0.1), (1, 0.3), (1, 0.30000001), (1, 1.0)])
    bins = {r["bin"]: r["n"] for r in metrics.calibration_curve(df, "hit", "score").collect()}
    assert bins == {0: 2, 2: 1, 3: 1, 9: 1}


def test_non_negative_weights():
    rng = np.random.default_rng(8)
    x = rng.normal(size=(300, 4))
    y = x @ np.array([1.5, -2.0, 0.0, 0.7]) + 0.1 * rng.normal(size=300)
    w = models.non_negative_weights(x.T @ x, x.T @ y)
    slope = x.T @ (y - x @ w)
    assert (w >= 0).all() and w[1] == 0
    assert np.allclose(slope[w > 0], 0, atol=1e-6) and (slope[w == 0] <= 1e-6).all()


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(300):
        a, b = rng.normal(), rng.normal()
        rows.append((i, float(a), float(b), "yes" if a + 0.3 * rng.normal() > 0.6 else "no", float(3 * a - b + 2)))
    return spark.createDataFrame(rows, "id long, a double, b double, y string, z double")


def test_search_rejects_what_does_not_fit(labelled):
    with pytest.raises(ValueError, match="does regression"):
        search.train_all([models.linear_regression()], labelled, "y", ["a"], "id")
    with pytest.raises(ValueError, match="does not fit"):
        search.train_all([models.logistic_regression()], labelled, "y", ["a"], "id", metric="r2")
    with pytest.raises(ValueError, match="task must be"):
        search.train_all([], labelled, "y", ["a"], "id", task="other")


def test_random_search_draws_no_more_than_there_are():
    assert len(search.choose_trials(models.logistic_regression(), "random", 10, 1)) == 3
    assert len(search.choose_trials(models.random_forest(), "random", 10, 1)) == 10
    assert models.combinations_of({"a": [1, 2], "b": 3}) == [{"a": 1, "b": 3}, {"a": 2, "b": 3}]
    with pytest.raises(ValueError):
        search.choose_trials(models.random_forest(), "bayes", 1, 1)


def test_sampler_touches_training_folds_only(labelled):
    """The sampler sees the rows of the other folds, never those it is judged on."""
    seen = []

    def sampler(df, label, features, key, seed):
        seen.append({r["id"] for r in df.select("id").collect()})
        return df

    from tallyloom.operators.split import with_folds

    folded = with_folds(models.with_code(labelled, "y", ["no", "yes"]).drop("y", "z"), ["id"], 2, name=search.FOLD)
    search.search(models.logistic_regression(5), [{}], folded, ["a", "b"], "id", 2, "accuracy", sampler, parallelism=1)
    assert len(seen) == 2 and not seen[0] & seen[1] and len(seen[0] | seen[1]) == 300


def test_failing_model_is_skipped(labelled, tmp_path):
    def broken(params, rows, seed):
        raise RuntimeError("cannot be built")

    bad = models.Candidate("Broken", "regression", broken, {})
    trained, errors = search.train_all([bad, models.linear_regression()], labelled, "z", ["a", "b"], "id", "regression", "r2",
                                       folds=2, model_dir=str(tmp_path))
    assert [t.name for t in trained] == ["LinearRegression"] and "Broken" in errors
    assert trained[0].cv_score == pytest.approx(1.0) and trained[0].size_kb > 0
    assert trained[0].best_params["positive"] is False


def test_non_negative_model_is_stored_and_read(labelled, tmp_path):
    rows = labelled.withColumn(models.LABEL, F.col("z"))
    model = models.fit_model(models.linear_regression(), {"positive": True}, rows, ["a", "b"], 0)
    assert list(model.stages[-1].coefficients) == pytest.approx([model.stages[-1].coefficients[0], 0.0])
    model.write().overwrite().save(str(tmp_path / "m"))
    from pyspark.ml import PipelineModel

    again = PipelineModel.load(str(tmp_path / "m"))
    assert again.stages[-1].intercept == model.stages[-1].intercept


def test_shuffle_is_a_permutation(spark):
    df = spark.range(200).select("id", F.col("id").cast("double").alias("a"), (-F.col("id")).cast("double").alias("b"))
    out = importance.shuffled(df, ["a", "b"], "id", 3, 42, 2).collect()
    for repeat in range(3):
        for feature, other in (("a", "b"), ("b", "a")):
            rows = [r for r in out if r["repeat"] == repeat and r["feature"] == feature]
            sign = {"a": 1, "b": -1}
            assert sorted(sign[feature] * r[feature] for r in rows) == list(range(200))
            assert all(r[other] == sign[other] * r["id"] for r in rows)
            assert sum(sign[feature] * r[feature] != r["id"] for r in rows) > 150


def test_unused_feature_has_no_importance(labelled):
    rows = labelled.withColumn(models.LABEL, F.col("z"))
    out = importance.permutation_importance(
        rows, lambda df: df.withColumn("prediction", 3 * F.col("a")), lambda df, by: search.score_table(df, "r2", by), ["a", "b"], "id", 2)
    got = {r["feature"]: r["importance"] for r in out.collect()}
    assert got["b"] == pytest.approx(0.0) and got["a"] > 0.5


def test_learning_curve(labelled):
    rows = learning.learning_curve(models.linear_regression(), {}, labelled, "z", ["a", "b"], "id", "r2", (0.2, 1.0), 2).orderBy("size").collect()
    assert [r["rows"] for r in rows] == [30, 150]
    assert all(r["valid_mean"] == pytest.approx(1.0) for r in rows)


def test_workflow(labelled):
    settings = workflow.Settings("y", "id", folds=2, stratify=True, learning_sizes=(0.5, 1.0))
    done = workflow.run(labelled.drop("z"), settings, [models.logistic_regression(10)], preprocessor=Preprocessor())
    assert set(done.report.tables) >= {"metrics", "roc_curve", "importances", "summary", "learning_curve"}
    learned = done.report.tables["learning_curve"].orderBy("size").collect()
    assert [(r["model"], r["size"]) for r in learned] == [("LogisticRegression", 0.5), ("LogisticRegression", 1.0)]
    got = {r["split"]: r for r in done.metrics.collect()}
    assert got["train"]["n"] == 240 and got["test"]["n"] == 60
    assert got["test"]["roc_auc"] > 0.9 and got["test"]["accuracy"] > 0.8
    assert evaluation.summary(done.metrics).count() == 1
    weights = importance.model_importances(labelled.sparkSession, done.trained[0].model, done.preprocessor.feature_names)
    assert weights.first()["feature"] == "a"


def test_report_of_all_tables(labelled, tmp_path):
    settings = workflow.Settings("y", "id", folds=2, stratify=True, learning_sizes=())
    done = workflow.run(labelled.drop("z"), settings, [models.logistic_regression(10)], preprocessor=Preprocessor())
    found = evaluation.report(
        done.trained, done.prepared, "y", "id", done.preprocessor.feature_names, summary_path=str(tmp_path / "summary"))
    assert set(found.tables) == {"metrics", "roc_curve", "pr_curve", "areas", "calibration", "confusion", "importances", "summary"}
    assert found.tables["confusion"].agg(F.sum("n")).first()[0] == 300
    assert {r["feature"] for r in found.tables["importances"].collect()} == set(done.preprocessor.feature_names)
    assert set(found.seconds) == {"LogisticRegression"} and list((tmp_path / "summary").glob("part-*"))


def test_areas_of_averaged_curves(spark):
    """Three classes, two models: the areas are those of the averaged curves of each model and split."""
    from tallyloom.operators import curves

    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        y = int(rng.integers(3))
        p = rng.dirichlet([3.0 if c == y else 1.0 for c in range(3)])
        rows.append(("m" if i % 2 else "n", "test" if i % 5 == 0 else "train", float(y), [float(v) for v in p]))
    table = spark.createDataFrame(rows, f"model string, split string, {models.LABEL} double, probability array<double>")
    got = {(r["model"], r["split"], r["curve"]): r["area"] for r in evaluation.mean_areas(table, 3).collect()}
    assert len(got) == 8
    own = table.filter("model = 'm' AND split = 'train'").withColumns({f"p{i}": F.col("probability")[i] for i in range(3)})
    want = curves.curve_area(curves.mean_curve(own, models.LABEL, {float(i): f"p{i}" for i in range(3)}, "roc")).first()[0]
    assert got["m", "train", "roc"] == pytest.approx(want) and 0.6 < want <= 1


def test_importances_fall_back_to_permutation(labelled):
    class Twice:
        def transform(self, df):
            return df.withColumn("prediction", 2 * F.col("a"))

    rows = labelled.withColumn(models.LABEL, 2 * F.col("a"))
    out = importance.importances(
        labelled.sparkSession, Twice(), rows, ["a", "b"], "id", "twice", lambda df, by: search.score_table(df, "r2", by), 2)
    got = {r["feature"]: r["importance"] for r in out.collect()}
    assert got["b"] == pytest.approx(0.0) and got["a"] > 0.5


def test_parts_with_two_of_three_labels_are_averaged(spark):
    rows = spark.createDataFrame([(0.0, 0.0), (2.0, 2.0), (2.0, 0.0)], f"{models.LABEL} double, prediction double")
    assert search.score_of(rows, "recall", classes=3) == pytest.approx(0.75)


def test_fold_without_a_score_is_an_error(labelled):
    rows = labelled.withColumn(models.LABEL, F.col("z"))
    folded = rows.withColumn(search.FOLD, (F.col("id") % 2).cast("int"))  # the third fold has no rows
    with pytest.raises(ValueError, match="fold 2 has no rows and gives no r2"):
        search.search(models.linear_regression(), [{}], folded, ["a"], "id", 3, "r2")
