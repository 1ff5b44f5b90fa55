from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import quality
from tallyloom.llm.logistic import fit
from tests.llm.frames import collected, documents


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int").withColumn("text", F.lit("x")).withColumn("id", F.lit(0))


def good(i):
    return f"Some ordinary words stand here, number {i}, and they end the sentence in a plain way. Then one more follows it."


def bad(i):
    return " ".join(["BUY!! NOW!! ###"] * (5 + i % 7))


@pytest.fixture(scope="module")
def corpus():
    return [(i, good(i) if i % 3 else bad(i), f"s{i % 4}", "en" if i % 2 else None) for i in range(400)]


def test_held_out_documents(spark, corpus):
    docs = documents(spark, corpus)
    named = labels(spark, [(i, int(i % 3 > 0)) for i in range(0, 400, 2)])
    got = collected(quality.scores(docs, named))
    assert all(got[i]["accepted"] == (i % 3 > 0) for i in range(400))
    out = quality.accepted(docs, named)
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == [i for i in range(400) if i % 3]


def test_given_table(spark):
    sf = "/root/testdata/sf0.1"
    docs, named = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    learned = quality.scores(docs, named.filter("doc_id % 2 = 0"))
    held = learned.join(named.filter("doc_id % 2 = 1"), "doc_id").select("accepted", "quality").collect()
    kept = [r["accepted"] for r in held if r["quality"] == 1]
    gone = [not r["accepted"] for r in held if r["quality"] == 0]
    assert np.mean(kept) > 0.995 and np.mean(gone) > 0.97


def test_rates_are_shrunk_like_by_hand(spark):
    rows = [("a", "p", 2.0), ("a", "p", -1.0), ("a", "q", 0.5), ("b", "p", -3.0), ("b", "p", 1.0), ("b", "p", 0.0)]
    df = spark.createDataFrame(rows, "host string, path string, evidence double")
    sites, found = quality.site_rates(df, 0.3)
    p = [1 / (1 + np.exp(-(e + 0.3))) for _, _, e in rows]
    assert found["rate"] == pytest.approx((sum(p) + 1) / 8)
    host, path, odds = quality.posterior(found, F.col("evidence"), F.col("site"))
    got = df.join(sites, ["host", "path"]).filter("evidence = 2.0").select(host.alias("h"), path.alias("p"), odds.alias("o")).first()
    h = (p[1] + p[2] + found["k_host"] * found["rate"]) / (2 + found["k_host"])
    q = (p[1] + found["k_path"] * h) / (1 + found["k_path"])
    assert (got["h"], got["p"], got["o"]) == (pytest.approx(h), pytest.approx(q), pytest.approx(2 + np.log(q / (1 - q))))


def test_sparse_sites_move_less(spark):
    rows = [("bad", "x", -3.0)] * 400 + [("rare", "x", -3.0)] * 2 + [("fine", "x", 3.0)] * 400
    sites, found = quality.site_rates(spark.createDataFrame(rows, "host string, path string, evidence double"), 0.0)
    host, *_ = quality.posterior(found, F.lit(0.0), F.col("site"))
    rate = {r["host"]: r["r"] for r in sites.select("host", host.alias("r")).collect()}
    assert rate["bad"] < rate["rare"] < found["rate"] < rate["fine"]


def test_without_labels_of_both_kinds(spark, corpus):
    docs = documents(spark, corpus[:20])
    for rows in ([], [(1, 1), (2, 1)], [(None, 1), (3, None)]):
        got = quality.scores(docs, labels(spark, rows)).collect()
        assert len(got) == 20 and all(r["evidence"] == 0 for r in got)


def test_odd_texts_ids_and_empty_tables(spark, corpus):
    named = labels(spark, [(i, int(i % 3 > 0)) for i in range(100)] + [(1, 0), (1, 1), (1, 1)])
    odd = [(1000, None), (1001, ""), (1002, " \n"), (1003, "x"), (1004, "word " * 50_000), (None, good(1)), (7, good(2)), (7, good(2))]
    got = quality.scores(documents(spark, corpus + odd), named).collect()
    assert len(got) == 408 and all(0 < r["score"] < 1 for r in got)
    assert quality.accepted(documents(spark, corpus + odd), named).filter("doc_id IS NULL").count() == 1
    assert quality.scores(documents(spark, []), named).count() == 0
    assert quality.accepted(documents(spark, []), named).count() == 0


def test_features_do_not_depend_on_the_block():
    texts = [b"", b"a", b"A B!! c", "é ### 12".encode(), b"x x x y", b"\n\n"]
    one = np.vstack([quality.features([t]) for t in texts])
    assert np.allclose(quality.features(texts), one)


def test_logistic_regression_finds_the_optimum():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    y = (rng.random(400) < 1 / (1 + np.exp(-(x @ [1.0, -2.0, 0.0] + 0.5)))).astype(float)
    model = fit(x, y, ridge=1e-3)
    p = 1 / (1 + np.exp(-model.log_odds(x)))
    z = (x - model.mean) / model.scale
    assert np.allclose(z.T @ (y - p) - 1e-3 * 400 * model.weights, 0, atol=1e-5) and abs((y - p).sum()) < 1e-5
