from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.functions import naming, tails
from tallyloom.functions.columns import nan_to_null, stable_hash
from tallyloom.functions.running import average_ranks, grouped_quantiles, quantiles_by, running_totals
from tallyloom.functions.selection import TooManyGroups, exact_quantiles, select_ranks


@pytest.mark.parametrize("raw, expected", [
    ("Unnamed: 0", "unnamed_0"), ("  Number of  Previous Admissions ", "number_of_previous_admissions"), ("Risk_Category", "risk_category"),
    ("__A--b__c", "ab_c"), ("Ü%", ""), ("a\tb\nc", "a_b_c"), ("X_ _Y", "x_y"),
])
def test_snake_case(raw, expected):
    assert naming.snake_case(raw) == expected


def test_bare_name():
    assert naming.bare_name("Length of Stay") == naming.bare_name("length_of_stay")


@pytest.mark.parametrize("f, d1, d2, p", [
    (0.42010612, 1, 498, 0.51718282), (4.0, 2, 10, 0.0529221), (1.0, 5, 5, 0.5), (0.0, 3, 7, 1.0), (1000.0, 1, 30, 0.0),
])
def test_f_tail(f, d1, d2, p):
    assert tails.f_tail(f, d1, d2) == pytest.approx(p, abs=1e-6)


@pytest.mark.parametrize("x, dof, p", [(3.841458820694124, 1, 0.05), (18.307038, 10, 0.05), (0.0, 4, 1.0), (200.0, 4, 0.0)])
def test_chi2_tail(x, dof, p):
    assert tails.chi2_tail(x, dof) == pytest.approx(p, abs=1e-6)


@pytest.mark.parametrize("dof", [10**6, 10**7, 10**8])
def test_tails_converge_at_many_degrees_of_freedom(dof):
    """By the normal form of Wilson and Hilferty, on both sides of the middle."""
    for z in (-2.0, 0.0, 2.0):
        x = dof * (1 - 2 / (9 * dof) + z * math.sqrt(2 / (9 * dof))) ** 3
        assert tails.chi2_tail(x, dof) == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), abs=1e-5)
    assert tails.f_tail(1.0, dof, dof) == pytest.approx(0.5, abs=1e-6)
    assert tails.f_tail(1.0, dof, 100 * dof) == pytest.approx(0.5, abs=1e-3)


def test_p_values_of_degenerate_tests():
    assert tails.f_p_value(None, 1, 3) is None
    assert tails.f_p_value(1.0, 1, 0) is None
    assert tails.f_p_value(math.inf, 1, 3) == 0.0
    assert tails.chi2_p_value(0.0, 0) == 1.0


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.5), (3, None)], "id int, x double")
    assert nan_to_null(df).filter("x IS NULL").count() == 2


def _numbers(spark, values, group=None):
    rows = [(float(v) if v is not None else None, group[i] if group else "a") for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "v double, g string").repartition(5)


@pytest.mark.parametrize("keep_rows", [200_000, 20])
def test_exact_quantiles_match_numpy(spark, keep_rows):
    """Half of the rows hold one value; a small limit forces the narrowing rounds."""
    rng = np.random.default_rng(5)
    values = np.concatenate([np.full(3000, 7.25), rng.lognormal(2, 2, 3000)])
    probs = (0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0)
    found = exact_quantiles(_numbers(spark, values), ["v"], probs, keep_rows=keep_rows)["v"]
    assert np.allclose(found, np.quantile(values, probs), rtol=1e-12)


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(_numbers(spark, [None, None]), ["v"], (0.5,)) == {"v": [None]}


@pytest.mark.parametrize("quantiles", [quantiles_by, grouped_quantiles])
def test_quantiles_per_group(spark, quantiles):
    rng = np.random.default_rng(6)
    values = np.round(rng.normal(size=2000), 2)
    groups = ["hot" if i % 3 else f"g{i % 7}" for i in range(2000)]
    found = {r["g"]: (r["n"], r["q"]) for r in quantiles(_numbers(spark, values, groups), "v", (0.1, 0.5), ["g"]).collect()}
    for g in set(groups):
        own = values[[x == g for x in groups]]
        assert found[g][0] == len(own)
        assert np.allclose(found[g][1], np.quantile(own, (0.1, 0.5)))


def test_many_groups_fall_back_to_running_totals(spark, monkeypatch):
    from tallyloom.functions import selection

    monkeypatch.setattr(selection, "MAX_GROUPS", 3)
    rows = _numbers(spark, range(100), [f"g{i % 10}" for i in range(100)])
    with pytest.raises(TooManyGroups):
        exact_quantiles(rows, ["v"], (0.5,), by=["g"])
    assert quantiles_by(rows, "v", (0.5,), ["g"]).count() == 10


def test_select_ranks_of_hashes(spark):
    rows = spark.range(5000).withColumn("h", stable_hash(["id"], 1))
    ordered = sorted(r["h"] for r in rows.collect())
    found = select_ranks(rows, "h", [], lambda _, n: [0, 999, n - 1], [0.2])
    assert found[()] == (5000, {0: ordered[0], 999: ordered[999], 4999: ordered[-1]})


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("buckets", [2, 16, 64])
def test_running_totals(spark, descending, buckets):
    rows = spark.range(300).select((F.col("id") % 3).alias("g"), (F.col("id") * 11 % 301).cast("double").alias("v"), F.col("id").alias("s"))
    got = running_totals(rows, "v", ["s"], by=["g"], descending=descending, following=["s"], buckets=buckets).collect()
    plain = rows.collect()
    for r in got:
        own = sorted((p for p in plain if p["g"] == r["g"]), key=lambda p: p["v"], reverse=descending)
        at = [p["v"] for p in own].index(r["v"])
        assert r["cum_s"] == sum(p["s"] for p in own[: at + 1])
        assert r["next_s"] == (own[at + 1]["s"] if at + 1 < len(own) else None)
    assert len(got) == 300


@pytest.mark.parametrize("distinct", [1_000, 1_000_000])
def test_the_largest_bucket_is_bounded(spark, distinct):
    """Also where half of the values lie in a thousandth of their range."""
    from tallyloom.functions import running

    x = F.col("id").cast("double")
    rows = spark.range(distinct).select(F.when(F.col("id") % 2 == 0, x).otherwise(x / 1000 + 0.25).alias("v"), F.lit(1).alias("s"))
    cut = running.with_bucket(rows, "v", ["s"], running.bucket_count(distinct))
    sizes = cut.groupBy("_bucket").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).orderBy("_bucket").collect()
    assert max(r["n"] for r in sizes) <= 1.5 * running.BUCKET_ROWS and sum(r["n"] for r in sizes) == distinct
    assert all(a["high"] < b["low"] for a, b in zip(sizes, sizes[1:]))


def test_many_buckets_grow_with_the_value(spark, monkeypatch):
    from tallyloom.functions import running

    monkeypatch.setattr(running, "BUCKET_ROWS", 7)
    values = [float(v) for v in np.random.default_rng(1).permutation(2000)]
    rows = spark.createDataFrame([(v, 1) for v in values], "v double, s long")
    got = {r["v"]: r["cum_s"] for r in running_totals(rows, "v", ["s"]).collect()}
    assert got == {v: int(v) + 1 for v in values}
    cut = running.with_bucket(rows, "v", ["s"], running.bucket_count(2000))
    assert cut.select("_bucket").distinct().count() > 200


def test_average_ranks(spark):
    ranks = {r["v"]: r["avg_rank"] for r in average_ranks(_numbers(spark, [1, 1, 2, 5, 5, 5, None]), "v").collect()}
    assert ranks == {1.0: 1.5, 2.0: 3.0, 5.0: 5.0}


def test_heavy_values_around_a_thin_tail_are_not_collected(spark, monkeypatch):
    """Half of the rows hold 0, half 1, and the wanted ranks lie in the few different values between."""
    from tallyloom.functions import selection

    rows = spark.range(200_000).select(
        F.when(F.col("id") < 3000, 0.1 + F.col("id") / 10_000).when(F.col("id") % 2 == 0, 0.0).otherwise(1.0).alias("v"))
    seen = []
    collect = selection._collect
    monkeypatch.setattr(selection, "_collect", lambda counted, by: seen.append(0) or _counted(collect(counted, by), seen))
    values = np.sort(np.array([r["v"] for r in rows.collect()]))
    wanted = [98_000, 98_499, 98_500, 99_000, 100_000, 101_400, 101_499, 101_500, 150_000]
    found = select_ranks(rows, "v", [], lambda *_: wanted, [0.5], keep_rows=500)
    assert found[()][1] == {r: values[r] for r in wanted}
    assert max(seen) <= 600


def _counted(found, seen):
    seen[-1] = sum(len(rows) for group in found.values() for rows in group.values())
    return found
