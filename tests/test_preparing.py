from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.operators import clip, iterative, kmodes, neighbors, prepare, resample, split
from tallyloom.operators.prepare import (
    Categorical, Constant, Mean, Median, MinMaxScale, MostFrequent, NoScale, Numeric, OneHot, Ordinal, Preprocessor, StandardScale,
)


@pytest.fixture(scope="module")
def mixed(spark):
    return spark.createDataFrame([
        (1, 1.0, 5, "a", True), (2, None, 5, "b", False), (3, 3.0, 5, None, True), (4, 8.0, 5, "b", True),
    ], "id long, x double, same long, c string, flag boolean")


def column(df, name, key="id"):
    return [r[name] for r in df.orderBy(key).collect()]


def test_default_routing(mixed):
    fitted = Preprocessor(keep=["id"]).fit(mixed)
    out = fitted.transform(mixed)
    assert out.columns == ["x", "same", "c_a", "c_b", "id", "flag"] == fitted.output_names
    x = np.array(column(out, "x"))
    assert x.mean() == pytest.approx(0) and x.std() == pytest.approx(1)
    assert column(out, "same") == [0.0] * 4
    assert column(out, "c_b") == [0.0, 1.0, 1.0, 1.0]
    assert all(r["c_a"] + r["c_b"] == 1 for r in out.collect())


def test_custom_columns_come_first(mixed):
    spec = {"same": Numeric(Constant(0), MinMaxScale()), "c": Categorical(Constant("missing"), Ordinal())}
    out = Preprocessor(spec, keep=["id"]).fit_transform(mixed)
    assert out.columns == ["same", "x", "c", "id", "flag"]
    assert column(out, "c") == [0.0, 1.0, 2.0, 1.0]


def test_statistics_come_from_the_fitted_frame(mixed, spark):
    fitted = Preprocessor({"x": Numeric(Median(), NoScale())}, keep=["id"]).fit(mixed.filter("id <> 4"))
    other = spark.createDataFrame([(9, None, 1, "zzz", None)], mixed.schema)
    row = fitted.transform(other).first()
    assert row["x"] == 2.0 and row["c_a"] == row["c_b"] == 0.0


def test_unfitted_transform_raises(mixed):
    with pytest.raises(ValueError, match="not fitted"):
        Preprocessor().transform(mixed)


def test_min_max_includes_the_fill(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 4.0), (3, None)], "id long, x double")
    out = Preprocessor({"x": Numeric(Constant(-6), MinMaxScale())}, keep=["id"]).fit_transform(df)
    assert column(out, "x") == [0.8, 1.0, 0.0]


def test_mode_ties_take_the_smallest(spark):
    df = spark.createDataFrame([(1, 7.0, "z"), (2, 3.0, "a"), (3, None, None)], "id long, x double, c string")
    spec = {"x": Numeric(MostFrequent(), NoScale()), "c": Categorical(MostFrequent(), None)}
    row = Preprocessor(spec, keep=["id"]).fit_transform(df).filter("id = 3").first()
    assert (row["x"], row["c"]) == (3.0, "a")


def test_sparse_on_request_and_unseen_is_zero(spark):
    df = spark.createDataFrame([(i, f"v{i:02d}") for i in range(6)], "id long, c string")
    fitted = Preprocessor({"c": Categorical(MostFrequent(), OneHot(sparse=True))}, keep=["id"]).fit(df)
    out = fitted.transform(df.union(spark.createDataFrame([(99, "new")], df.schema)))
    vectors = {r["id"]: r["c_vec"].toArray().tolist() for r in out.collect()}
    assert vectors[2] == [0, 0, 1, 0, 0, 0] and vectors[99] == [0] * 6


def test_many_categories_need_no_limit(spark):
    df = spark.createDataFrame([(i, f"v{i:04d}") for i in range(700)], "id long, c string")
    codes = Preprocessor({"c": Categorical(MostFrequent(), Ordinal(unknown=-1.0))}, keep=["id"]).fit(df)
    got = {r["id"]: r["c"] for r in codes.transform(df.union(spark.createDataFrame([(9999, "new")], df.schema))).collect()}
    assert got == {**{i: float(i) for i in range(700)}, 9999: -1.0}
    assert len(Preprocessor(keep=["id"]).fit(df).feature_names) == 700


def test_dictionary_ranks_every_value_over_many_ranges(spark):
    from tallyloom.functions.dictionary import dictionary, sizes

    random.seed(2)
    texts = sorted({"".join(random.choice("abÄz日") for _ in range(random.randrange(4))) for _ in range(900)}, key=str.encode)
    rows = [(i, t, "hot" if i % 3 else None) for i, t in enumerate(texts * 3)]
    df = spark.createDataFrame(rows, "id long, a string, b string").repartition(11)
    table = dictionary(df, {"a": F.col("a"), "b": F.col("b"), "none": F.lit(None).cast("string")})
    got = {(r["column"], r["value"]): r["code"] for r in table.collect()}
    assert got == {**{("a", t): i for i, t in enumerate(texts)}, ("b", "hot"): 0}
    assert sizes(table) == {"a": len(texts), "b": 1}


def test_dense_one_hot_has_a_width(spark, monkeypatch):
    df = spark.createDataFrame([(i, f"v{i}") for i in range(12)], "id long, c string")
    monkeypatch.setattr(prepare, "MAX_COLUMNS", 10)
    with pytest.raises(ValueError, match="sparse=True"):
        Preprocessor(keep=["id"]).fit(df)
    monkeypatch.setattr(prepare, "MAX_VECTOR", 10)
    with pytest.raises(ValueError, match="Ordinal"):
        Preprocessor({"c": Categorical(MostFrequent(), OneHot(sparse=True))}, keep=["id"]).fit(df)
    assert Preprocessor({"c": Categorical(MostFrequent(), Ordinal())}, keep=["id"]).fit(df).feature_names == ["c"]


def test_imputers_of_several_columns_in_the_routing(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=300)
    x = np.stack([base, 2 * base + 0.1 * rng.normal(size=300), rng.normal(size=300)], axis=1)
    x[rng.random(x.shape) < 0.2] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r], "k") for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, t string")
    rounds = iterative.IterativeImputer(max_iter=3)
    spec = {"a": Numeric(rounds, NoScale()), "b": Numeric(rounds, StandardScale()), "c": Numeric(neighbors.KNNImputer(4), NoScale())}
    out = Preprocessor(spec, key="id").fit(df).transform(df)
    want = iterative.IterativeImputer(max_iter=3).fit_transform(df, ["a", "b"]).toPandas().sort_values("id")
    got = out.toPandas().sort_values("id")
    assert np.allclose(got["a"], want["a"]) and np.allclose(got["b"], (want["b"] - want["b"].mean()) / want["b"].std(ddof=0))
    # A column that is imputed alone has nothing to find neighbours by: its mean.
    assert np.allclose(got["c"], np.where(np.isnan(x[:, 2]), np.nanmean(x[:, 2]), x[:, 2]))
    with pytest.raises(ValueError, match="key"):
        Preprocessor({"a": Numeric(neighbors.KNNImputer(2))}, keep=["id"]).fit(df)


def test_numbers_and_booleans_that_pass_through_are_features(spark):
    df = spark.createDataFrame([(1, 2, True, 1.0, None)], "id long, n int, b boolean, x double, d date")
    fitted = Preprocessor(keep=["id"]).fit(df)
    assert fitted.feature_names == ["x", "n", "b"] and fitted.output_names == ["x", "id", "n", "b", "d"]
    assert fitted.transform(df).columns == fitted.output_names


@pytest.fixture(scope="module")
def skewed(spark):
    values = [float(v) for v in [0, 1, 2, 3, 4, 5, 6, 7, 8, 100]]
    return spark.createDataFrame([(i, v, 1.0) for i, v in enumerate(values)] + [(10, None, 1.0)], "id long, v double, same double")


def clipped(method, threshold, values):
    v = np.array(values)
    if method == "zscore":
        low, high = v.mean() - threshold * v.std(ddof=1), v.mean() + threshold * v.std(ddof=1)
    elif method == "iqr":
        q1, q3 = np.quantile(v, [0.25, 0.75])
        low, high = q1 - threshold * (q3 - q1), q3 + threshold * (q3 - q1)
    elif method == "quantile":
        q = np.quantile(v, threshold)
        low, high = (-np.inf, q) if threshold > 0.5 else (q, np.inf)
    else:
        m = np.median(v)
        d = np.median(np.abs(v - m))
        low, high = m - threshold * d, m + threshold * d
    return np.clip(v, low, high)


@pytest.mark.parametrize("method, threshold", [
    ("zscore", 1.0), ("iqr", 1.5), ("quantile", 0.9), ("quantile", 0.1), ("quantile", 0.5), ("mad", 2.0),
])
def test_clipping(skewed, method, threshold):
    out = clip.OutlierClipper(method, threshold).fit_transform(skewed, ["v", "same"])
    got = column(out, "v")
    assert got[-1] is None
    assert np.allclose(got[:-1], clipped(method, threshold, column(skewed, "v")[:-1]))
    assert column(out, "same") == [1.0] * 11


def test_clipper_rejects_bad_settings(skewed):
    with pytest.raises(ValueError):
        clip.OutlierClipper("quantile", 1.5).fit(skewed, ["v"])
    with pytest.raises(ValueError):
        clip.OutlierClipper("domain").fit(skewed, ["v"])
    with pytest.raises(ValueError):
        clip.OutlierClipper("other")


# splits -------------------------------------------------------------------------------------------------------------

def test_split_is_exact_disjoint_and_stratified(spark):
    df = spark.range(1003).withColumn("y", F.when(F.col("id") % 3 == 0, "rare").otherwise("often"))
    train, test = split.split_dataset(df, "y", ["id"], 0.2, stratify=True)
    assert test.count() == 201 and train.count() == 802
    assert train.join(test, "id").count() == 0
    shares = {r["y"]: r["count"] for r in test.groupBy("y").count().collect()}
    assert abs(shares["rare"] - 0.2 * 335) <= 1
    assert split.stack_splits(train, test).count() == 1003
    with pytest.raises(ValueError):
        split.split_dataset(df, "absent", ["id"])


def test_split_needs_no_shuffle_of_rows(spark):
    plan = split.with_split(spark.range(1000), ["id"], 0.3)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_folds_differ_by_one(spark):
    counts = [r["count"] for r in split.with_folds(spark.range(103), ["id"], 4).groupBy("fold").count().collect()]
    assert sorted(counts) == [25, 26, 26, 26]


# clustering ---------------------------------------------------------------------------------------------------------

def test_kmodes_imputer_on_four_rows(spark):
    rows = [("Male", "Yes", "Hypertension"), ("Male", "No", "Hypertension"), ("Female", "Yes", "Diabetes"), ("Female", "No", "Hypertension")]
    names = "Gender string, Smoking_Status string, Comorbidity string"
    train = spark.createDataFrame(rows, names)
    test = spark.createDataFrame([(a, b, "unknown") for a, b, _ in rows], names)
    fitted = kmodes.KModesImputer(["Gender", "Smoking_Status"], n_clusters=4).fit(train, "Comorbidity")
    assert {tuple(r) for r in fitted.transform(test).collect()} == set(rows)
    with pytest.raises(KeyError):
        kmodes.KModesImputer(["absent"]).fit(train, "Comorbidity")


@pytest.mark.parametrize("init", ["Cao", "Huang"])
def test_kmodes_finds_clear_clusters(spark, init):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(300):
        values = [f"{i % 3}{j}" for j in range(6)]
        values[int(rng.integers(6))] = "odd"
        rows.append((i, *values))
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"c{j} string" for j in range(6)))
    model = kmodes.KModes(3, init).fit(df, [f"c{j}" for j in range(6)])
    assert model.cost == 300
    labels = model.transform(df).withColumn("truth", F.col("id") % 3).groupBy("truth", "cluster").count()
    assert labels.count() == 3


def test_preprocessor_with_kmodes(spark):
    rows = [(i, "mf"[i % 2], "x" if i % 2 else "y") for i in range(10)] + [(10, "m", "unknown"), (11, "f", None)]
    df = spark.createDataFrame(rows, "id long, g string, t string")
    spec = {"t": Categorical(kmodes.KModesImputer(["g"], n_clusters=2), OneHot())}
    out = Preprocessor(spec, keep=["id", "g"]).fit_transform(df)
    assert set(out.columns) == {"t_x", "t_y", "id", "g"}
    got = {r["id"]: (r["t_x"], r["t_y"]) for r in out.collect()}
    assert got[10] == (0.0, 1.0) and got[11] == (1.0, 0.0)


# neighbours ---------------------------------------------------------------------------------------------------------

def brute_force(x, keys, k, own=True):
    """Rows of the k nearest by (distance, key); a row is not its own neighbour."""
    width = x.shape[1]
    gap = x[:, None, :] - x[None, :, :]
    both = ~np.isnan(gap)
    with np.errstate(divide="ignore", invalid="ignore"):
        away = np.sqrt(np.where(both, gap**2, 0).sum(2) * (width / both.sum(2)))
    out = []
    for i in range(len(x)):
        order = [j for j in np.lexsort((keys, away[i])) if j != i and both[i, j].any()]
        out.append(order[:k])
    return out


@pytest.fixture(scope="module")
def crowd(spark):
    """A third of the rows share one point; some cells are missing."""
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(size=(360, 2)), 1)
    x[:120] = (0.0, 0.0)
    gaps = x.copy()
    gaps[rng.random((360, 2)) < 0.1] = np.nan
    label = np.where(rng.random(360) < 0.8, "big", "small")
    rows = [(i, *[None if np.isnan(v) else float(v) for v in gaps[i]], str(label[i])) for i in range(360)]
    return spark.createDataFrame(rows, "id long, a double, b double, y string").repartition(4), gaps, label


def test_knn_imputer_equals_brute_force_across_cells(crowd):
    df, x, _ = crowd
    out = neighbors.KNNImputer(3, cell_points=40).fit(df, ["a", "b"], "id").transform(df)
    got = np.array([[r["a"], r["b"]] for r in out.orderBy("id").collect()])
    for j in range(2):
        donors = np.flatnonzero(~np.isnan(x[:, j]))
        for i in np.flatnonzero(np.isnan(x[:, j])):
            near = brute_force(np.vstack([x[donors], x[i]]), np.append(donors, 10**6), 3)[-1]
            assert got[i, j] == pytest.approx(x[donors[near], j].mean() if near else np.nanmean(x[:, j]))
    assert np.allclose(got[~np.isnan(x)], x[~np.isnan(x)])


def test_edited_neighbours_equal_brute_force(crowd):
    df, x, label = crowd
    full = ~np.isnan(x).any(axis=1)
    keys = np.flatnonzero(full)
    near = brute_force(x[full], keys, 5)
    own = label[full]
    kept = {
        int(keys[i]) for i in range(len(keys))
        if own[i] != "big" or min(set(own[near[i]]), key=lambda v: (-(own[near[i]] == v).sum(), v)) == "big"
    }
    out = resample.edited_nearest_neighbours(df.dropna(), "y", ["a", "b"], "id", cell_points=50)
    assert {r["id"] for r in out.collect()} == kept


def test_smote_balances_and_stays_on_segments(crowd):
    df, x, label = crowd
    rows = df.dropna()
    out = resample.smote(rows, "y", ["a", "b"], "id").collect()
    counts = {c: sum(r["y"] == c for r in out) for c in ("big", "small")}
    assert counts["big"] == counts["small"]
    small = [i for i in range(360) if label[i] == "small" and not np.isnan(x[i]).any()]
    near = dict(zip(small, brute_force(x[small], np.array(small), 5)))
    for r in (r for r in out if r["synthetic"]):
        start = x[r["id"]]
        ends = [x[small[j]] for j in near[r["id"]]]
        step = np.array([r["a"], r["b"]]) - start
        on = [np.allclose(step[0] * (e - start)[1], step[1] * (e - start)[0], atol=1e-9) and
              (np.abs(step) <= np.abs(e - start) + 1e-9).all() for e in ends]
        assert any(on)


def test_smote_copies_beyond_one_run(spark, monkeypatch):
    monkeypatch.setattr(resample, "COPIES_PER_ROW", 3)
    rows = [(i, float(i), "many") for i in range(100)] + [(200 + i, float(i), "few") for i in range(7)]
    out = resample.smote(spark.createDataFrame(rows, "id long, a double, y string"), "y", ["a"], "id")
    assert out.filter("y = 'few'").count() == 100
    assert out.filter("synthetic").select("id", "copy").distinct().count() == 93


def test_smote_needs_enough_rows(spark):
    rows = [(i, float(i), "many") for i in range(10)] + [(100, 1.0, "few")]
    with pytest.raises(ValueError, match="more than 5"):
        resample.smote(spark.createDataFrame(rows, "id long, a double, y string"), "y", ["a"], "id")


def test_sampler_names():
    assert resample.choose_sampler(None) is None and resample.choose_sampler("null") is None
    assert resample.choose_sampler("smote-enn") is resample.smote_enn
    with pytest.raises(ValueError):
        resample.choose_sampler("other")


# iterative imputer --------------------------------------------------------------------------------------------------

def rounds_by_hand(x, rounds, tol=1e-3):
    has = ~np.isnan(x)
    z = np.where(has, x, np.nanmean(x, axis=0))
    order = np.argsort((~has).sum(0), kind="stable")
    for _ in range(rounds):
        before = z.copy()
        for j in order:
            rest = [i for i in range(x.shape[1]) if i != j]
            a, b = z[has[:, j]][:, rest], x[has[:, j], j]
            ac, bc = a - a.mean(0), b - b.mean()
            w = iterative.bayesian_ridge(len(b), ac.T @ ac, ac.T @ bc, bc @ bc)
            z[~has[:, j], j] = b.mean() + (z[~has[:, j]][:, rest] - a.mean(0)) @ w
        if np.abs(z - before).max() < tol * np.abs(x[has]).max():
            break
    return z


def test_iterative_imputer_equals_array_arithmetic(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(200, 1)) * 3 + 50
    x = np.hstack([base, 2 * base + rng.normal(size=(200, 1)), -base + rng.normal(size=(200, 1))])
    x[rng.random(x.shape) < 0.15] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double")
    out = iterative.IterativeImputer(max_iter=4).fit_transform(df, ["a", "b", "c"])
    got = np.array([[r["a"], r["b"], r["c"]] for r in out.orderBy("id").collect()])
    assert np.allclose(got, rounds_by_hand(x, 4), atol=1e-6)
    again = iterative.IterativeImputer(max_iter=2).fit(df, ["a", "b", "c"]).transform(df)
    replay = np.array([[r["a"], r["b"], r["c"]] for r in again.orderBy("id").collect()])
    assert np.allclose(replay, rounds_by_hand(x, 2), atol=1e-6)


def test_iterative_imputer_by_scans_gives_the_same(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(120, 4)) @ rng.normal(size=(4, 4))
    x[rng.random(x.shape) < 0.25] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double").repartition(3)
    by_patterns = iterative.IterativeImputer(max_iter=2).fit(df, list("abcd"))
    monkeypatch.setattr(iterative, "MAX_PATTERNS", 3)
    by_scans = iterative.IterativeImputer(max_iter=2).fit(df, list("abcd"))
    for own, other in zip(by_patterns.rounds, by_scans.rounds):
        for (i, w, c), (j, v, d) in zip(own, other):
            assert i == j and np.allclose(w, v, atol=1e-8) and np.isclose(c, d, atol=1e-8)
    assert np.allclose(np.array([r["x"] for r in by_scans.transform(df).orderBy("id").select(F.array(*"abcd").alias("x")).collect()]),
                       rounds_by_hand(x, 2), atol=1e-6)


def test_iterative_imputer_takes_three_jobs(spark):
    df = spark.range(200).select(F.col("id"), *[F.when(F.col("id") % p != 0, F.sqrt(F.col("id") + p)).alias(f"c{p}") for p in (2, 3, 5, 7)])
    spark.sparkContext.setJobGroup("fit", "fit")
    fitted = iterative.IterativeImputer().fit(df, ["c2", "c3", "c5", "c7"])
    stages = spark.sparkContext.statusTracker().getJobIdsForGroup("fit")
    spark.sparkContext.setJobGroup("transform", "transform")
    fitted.transform(df).collect()
    assert len(fitted.rounds) > 0 and len(spark.sparkContext.statusTracker().getJobIdsForGroup("transform")) <= 2
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # Three actions; adaptive execution runs each exchange of an action as a job of its own.
    assert len(stages) <= 8


def test_stratified_split_of_very_many_classes(spark, monkeypatch):
    """20,000 classes and a large one: the quotas and cuts of a sort, and those of the path for few classes."""
    from collections import Counter, defaultdict

    rows = spark.range(60_000).select("id", F.when(F.col("id") % 3 == 0, -1).when(F.col("id") % 1000 == 1, None).otherwise(F.col("id") % 20_011).alias("c"))
    hashed = rows.withColumn("h", split.stable_hash(["id"], 42)).collect()
    of = defaultdict(list)
    for r in hashed:
        of[(r["c"],)].append((r["h"], r["id"]))
    assert len(of) > split.MAX_CLASSES
    quota = split._largest_remainder({k: len(v) for k, v in of.items()}, 12_000)
    got = {r["id"] for r in split.with_split(rows, ["id"], 0.2, "c").filter("split = 'test'").collect()}
    assert len(got) == 12_000
    counts = Counter(r["c"] for r in hashed if r["id"] in got)
    # Equal fractions go to the lesser text here and there.
    texts = {("None" if k[0] is None else str(k[0])): v for k, v in quota.items()}
    assert {("None" if c is None else str(c)): n for c, n in counts.items()} == {t: n for t, n in texts.items() if n} or sum(
        abs(counts.get(k[0], 0) - n) for k, n in quota.items()) <= 4
    for k, own in of.items():
        own.sort()
        assert {i for _, i in own[: counts[k[0]]]} <= got


def test_stratified_folds_of_very_many_classes(spark, monkeypatch):
    rows = spark.range(3000).select("id", F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 501)).alias("c"))
    few = {r["id"]: r["fold"] for r in split.with_folds(rows, ["id"], 5, "c").collect()}
    monkeypatch.setattr(split, "MAX_CLASSES", 10)
    many = {r["id"]: r["fold"] for r in split.with_folds(rows, ["id"], 5, "c").collect()}
    assert few == many


def knn_by_hand(x, k):
    """Distances over shared columns, scaled; the mean of the k nearest donors, equal ones by row number."""
    out = x.copy()
    width = x.shape[1]
    for i in range(len(x)):
        for j in np.flatnonzero(np.isnan(x[i])):
            shared = ~np.isnan(x[i]) & ~np.isnan(x)
            with np.errstate(divide="ignore", invalid="ignore"):
                d = np.sqrt(np.where(shared, (x - x[i]) ** 2, 0).sum(1) * width / shared.sum(1))
            donors = [r for r in np.lexsort((np.arange(len(x)), d)) if not np.isnan(x[r, j]) and np.isfinite(d[r]) and r != i][:k]
            out[i, j] = x[donors, j].mean() if donors else np.nanmean(x[:, j])
    return out


@pytest.mark.parametrize("boxes, block", [(50_000, 4096), (3, 40)])
def test_knn_imputer_with_many_gapped_columns(spark, monkeypatch, boxes, block):
    """Twelve columns with free patterns make more spaces than were allowed once; boxes as arrays and as a table."""
    monkeypatch.setattr(neighbors, "MAX_BOXES", boxes)
    monkeypatch.setattr(neighbors, "BLOCK_CELLS", block)
    rng = np.random.default_rng(21)
    x = np.round(rng.normal(size=(250, 12)), 3)
    x[rng.random(x.shape) < 0.3] = np.nan
    columns = [f"c{i}" for i in range(12)]
    rows = [(f"k{i:03d}", *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id string, " + ", ".join(f"{c} double" for c in columns))
    spaces = {(j, tuple(np.isnan(r))) for r in x for j in np.flatnonzero(~np.isnan(r))}
    out = neighbors.KNNImputer(3, cell_points=64).fit(df, columns, "id").transform(df).orderBy("id")
    got = np.array([[r[c] for c in columns] for r in out.collect()])
    assert len(spaces) > 1000 and np.allclose(got, knn_by_hand(x, 3))


def test_resampling_with_text_keys(spark):
    rng = np.random.default_rng(3)
    rows = [(f"k{i}", "a" if i < 60 else "b", float(rng.normal()), float(rng.normal())) for i in range(80)]
    df = spark.createDataFrame(rows, "id string, y string, u double, v double")
    grown = resample.smote(df, "y", ["u", "v"], "id")
    assert {r["y"]: r["count"] for r in grown.groupBy("y").count().collect()} == {"a": 60, "b": 60}
    assert grown.filter("NOT synthetic").count() == 80 and set(grown.select("id").distinct().toPandas()["id"]) <= {r[0] for r in rows}
    cleaned = resample.edited_nearest_neighbours(df, "y", ["u", "v"], "id")
    numbers = resample.edited_nearest_neighbours(df.withColumn("id", F.substring("id", 2, 9).cast("long")), "y", ["u", "v"], "id")
    assert cleaned.columns == df.columns and 20 <= cleaned.count() <= 80 and numbers.count() > 20
    assert resample.smote_enn(df, "y", ["u", "v"], "id").count() > 60
