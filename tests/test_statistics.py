from __future__ import annotations

import numpy as np
import pytest

from tallyloom.operators import bivariate, compare, profile


@pytest.fixture(scope="module")
def pairs(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(600):
        x = float(np.round(rng.normal(), 1))
        rows.append((i, x if i % 17 else None, float(np.round(2 * x + rng.normal(), 1)), "ab"[i % 2] if i % 13 else None, "pqr"[int(x > 0) + i % 2]))
    return spark.createDataFrame(rows, "id long, x double, y double, two string, three string")


def arrays(df, *columns):
    rows = df.select(*columns).dropna().collect()
    return [np.array([r[c] for r in rows]) for c in columns]


def ranks(v):
    return np.array([(v < a).sum() + ((v == a).sum() + 1) / 2 for a in v])


def test_pearson_and_spearman(pairs):
    x, y = arrays(pairs, "x", "y")
    row = bivariate.pearson(pairs, "x", "y").first()
    assert row["r"] == pytest.approx(np.corrcoef(x, y)[0, 1])
    assert row["n"] == len(x) and row["p_value"] < 1e-10 and row["effect"] == "very strong positive"
    assert bivariate.spearman(pairs, "x", "y").first()["r"] == pytest.approx(np.corrcoef(ranks(x), ranks(y))[0, 1])


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, float(i)) for i in range(5)], "a double, b double")
    row = bivariate.pearson(df, "a", "b").first()
    assert row["r"] is None and row["p_value"] is None and row["effect"] == "not significant"
    assert profile.shape_statistics(df, ["a"]).first()["skewness"] == 0.0


def test_perfect_correlation(spark):
    df = spark.createDataFrame([(float(i), -2.0 * i) for i in range(6)], "a double, b double")
    row = bivariate.pearson(df, "a", "b").first()
    assert row["p_value"] == pytest.approx(0.0) and row["effect"] == "very strong negative"


@pytest.mark.parametrize("r, band", [
    (0.7, "very strong positive"), (0.5, "strong positive"), (0.3, "moderate positive"), (0.29, "weak"), (-0.3, "weak"),
    (-0.31, "moderate negative"), (-0.5, "moderate negative"), (-0.7, "strong negative"), (-0.71, "very strong negative"),
])
def test_bands(r, band):
    assert bivariate._signed_band(r) == band


def test_anova_by_hand(pairs):
    v, g = arrays(pairs, "y", "three")
    parts = [v[g == k] for k in sorted(set(g))]
    between = sum(len(p) * (p.mean() - v.mean()) ** 2 for p in parts) / (len(parts) - 1)
    within = sum(((p - p.mean()) ** 2).sum() for p in parts) / (len(v) - len(parts))
    row = bivariate.anova(pairs, "y", "three").first()
    assert row["f"] == pytest.approx(between / within)
    assert row["effect"] == "very strong"


def test_point_biserial_codes_in_sorted_order(pairs):
    v, g = arrays(pairs, "y", "two")
    assert bivariate.point_biserial(pairs, "y", "two").first()["r"] == pytest.approx(np.corrcoef(g == "b", v)[0, 1])


def chi2_by_hand(table, yates):
    table = np.array(table, dtype=float)
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    gap = np.abs(table - expected)
    if yates:
        gap = gap - np.minimum(0.5, gap)
    return (gap**2 / expected).sum()


@pytest.mark.parametrize("table, yates", [
    ([[10, 20], [30, 5]], True), ([[0, 7], [9, 3]], True), ([[5, 5], [5, 5]], True), ([[5, 0, 1], [2, 8, 0]], False),
    ([[3, 1], [0, 4], [2, 2]], False),
])
def test_chi_square(spark, table, yates):
    rows = [(f"r{i}", f"c{j}") for i, line in enumerate(table) for j, n in enumerate(line) for _ in range(n)]
    row = bivariate.chi_square(spark.createDataFrame(rows, "a string, b string"), "a", "b").first()
    assert row["chi2"] == pytest.approx(chi2_by_hand(table, yates), abs=1e-9)
    n, smaller = len(rows), min(len(table), len(table[0])) - 1
    assert row["cramers_v"] == pytest.approx(np.sqrt(row["chi2"] / (n * smaller)), abs=1e-9)


def test_one_category_is_no_association(spark):
    row = bivariate.chi_square(spark.createDataFrame([("a", "x"), ("a", "y")], "a string, b string"), "a", "b").first()
    assert (row["chi2"], row["p_value"], row["cramers_v"], row["effect"]) == (0.0, 1.0, None, "not significant")


def test_dispatch(pairs):
    assert "spearman" in bivariate.analyse_pair(pairs, "x", "y")
    assert "point_biserial" in bivariate.analyse_pair(pairs, "two", "y")
    assert "anova" in bivariate.analyse_pair(pairs, "y", "three")
    assert "chi_square" in bivariate.analyse_pair(pairs, "two", "three")
    with pytest.raises(ValueError):
        bivariate.analyse_pair(pairs, "x", "absent")


def test_analyse_column(pairs, spark):
    numeric = profile.analyse_column(pairs, "x")
    assert numeric["outliers"].first()["method"] == "zscore"
    assert numeric["histogram"].agg({"n": "sum"}).first()[0] == pairs.filter("x IS NOT NULL").count()
    assert profile.analyse_column(pairs, "two")["frequency"].count() == 2
    with pytest.raises(ValueError):
        profile.analyse_column(spark.sql("SELECT array(1) AS a"), "a")


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(4.0,), (4.0,)], "v double")
    rows = profile.histogram(df, "v", 2).orderBy("bin").collect()
    assert [(r["lower"], r["upper"], r["n"]) for r in rows] == [(3.5, 4.0, 0), (4.0, 4.5, 2)]


def test_no_identifier_column(pairs):
    assert profile.identifier_uniqueness(pairs, "absent") is None


def test_rename_is_neither_dropped_nor_added():
    assert compare.column_changes(["Length of Stay", "Gone", "same"], ["length_of_stay", "same", "new"]) == (
        ["Gone"], ["new"], [("Length of Stay", "length_of_stay")])


def test_correlations_and_nullity_of_two_hundred_columns(spark):
    """Against numpy, with gaps, a constant column and large offsets; the plan does not grow with the pairs."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(150, 200)) + rng.normal(size=(150, 1)) + 1e6
    x[:, 7] = 3.5
    x[rng.random(x.shape) < 0.1] = np.nan
    names = [f"c{i}" for i in range(200)]
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in r) for r in x], ", ".join(f"{n} double" for n in names)).repartition(5)
    got = {(r["column_a"], r["column_b"]): r["r"] for r in bivariate.correlation_matrix(df, names).collect()}
    gaps = {(r["column_a"], r["column_b"]): r["r"] for r in profile.nullity_correlation(df).collect()}
    assert len(got) == 200 * 200
    for i, j in [(0, 1), (3, 199), (50, 51), (120, 4)]:
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert got[f"c{i}", f"c{j}"] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)
        i, j = min(i, j), max(i, j)
        assert gaps[f"c{i}", f"c{j}"] == pytest.approx(np.corrcoef(np.isnan(x[:, i]), np.isnan(x[:, j]))[0, 1], abs=1e-12)
    assert got["c7", "c7"] == 1.0 and got["c7", "c8"] is None


def test_correlations_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert {r["r"] for r in bivariate.correlation_matrix(df, ["a", "b"]).collect()} == {None, 1.0}
    assert profile.nullity_correlation(df).count() == 0
