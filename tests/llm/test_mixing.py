from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest

from tallyloom.llm import mixing
from tests.llm.frames import documents


@pytest.fixture(scope="module")
def corpus():
    random.seed(12)
    rows = []
    for s, n in (("big", 900), ("mid", 200), ("small", 40), (None, 30)):
        rows += [(len(rows) + i, " ".join(["w"] * random.randrange(0, 60)), s) for i in range(n)]
    return rows


def tokens(text):
    return len((text or "").split()) + 1


def shares(rows):
    out = Counter()
    for _, text, source in rows:
        out[source] += tokens(text)
    return out


def entropy_at(sums, a):
    total = sum(sums.values())
    w = [(t / total) ** a for t in sums.values()]
    return -sum(x / sum(w) * math.log(x / sum(w)) for x in w)


def test_exponent_meets_the_entropy(spark, corpus):
    sums = shares(corpus)
    sources = spark.createDataFrame([(str(s), 1, t) for s, t in sums.items()], "source string, docs long, tokens long")
    found = mixing.temperature(sources, entropy=0.8, repetitions=1000.0)
    assert entropy_at(sums, found.exponent) == pytest.approx(0.8 * math.log(4), abs=1e-5)
    assert found.entropy == pytest.approx(entropy_at(sums, found.exponent))
    assert mixing.temperature(sources, entropy=0.0).exponent == 1 and mixing.temperature(sources, entropy=1.0, repetitions=1e6).exponent == pytest.approx(0, abs=1e-4)


def test_repetitions_raise_the_exponent(spark, corpus):
    sums = shares(corpus)
    total = sum(sums.values())
    sources = spark.createDataFrame([(str(s), 1, t) for s, t in sums.items()], "source string, docs long, tokens long")
    found = mixing.temperature(sources, entropy=1.0, repetitions=3.0, budget=2.0 * total)
    w = {s: (t / total) ** found.exponent / found.normaliser for s, t in sums.items()}
    assert max(w[s] * 2.0 * total / t for s, t in sums.items()) == pytest.approx(3.0, abs=1e-3)
    assert sum(w.values()) == pytest.approx(1)
    assert mixing.temperature(sources, repetitions=1.5, budget=2.0 * total).exponent == 1


@pytest.mark.parametrize("budget", [None, 8000, 90_000])
def test_draws_meet_the_weights(spark, corpus, budget, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 16)
    sums = shares(corpus)
    rows = mixing.draws(documents(spark, corpus).repartition(5), entropy=0.8, repetitions=50.0, budget=budget).collect()
    drawn, weight, longest = Counter(), {}, max(tokens(t) for _, t, _ in corpus)
    by_source = defaultdict(list)
    for r in rows:
        drawn[r["source"]] += r["tokens"]
        weight[r["source"]] = r["weight"]
        by_source[r["source"]].append(r)
    total = budget or sum(sums.values()) * max(t / sum(sums.values()) / weight[s] for s, t in sums.items())
    for s in sums:
        assert 0 <= weight[s] * total - drawn[s] < longest + 1e-6
    texts = {d: (t, s) for d, t, s in corpus}
    for s, own in by_source.items():
        each = Counter(r["doc_id"] for r in own)
        assert max(each.values()) - min([each.get(d, 0) for d, (_, src) in texts.items() if src == s]) <= 1
        for r in own:
            assert r["tokens"] == tokens(texts[r["doc_id"]][0])
    if budget is None:
        assert {r["doc_id"] for r in rows} == set(texts)


def test_epochs_are_permutations(spark, corpus, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 16)
    rows = [r for r in mixing.draws(documents(spark, corpus), entropy=1.0, repetitions=50.0).collect() if r["source"] == "small"]
    orders = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["epoch"], r["block_place"], r["place"])):
        orders[r["epoch"]].append(r["doc_id"])
    assert len(orders) > 5 and sorted(orders[0]) == sorted(orders[1]) and orders[0] != orders[1]


def test_documents_keep_their_columns_and_are_repeated(spark, corpus):
    docs = documents(spark, corpus)
    out = mixing.mixed_documents(docs, entropy=0.9)
    assert out.columns == docs.columns
    got = Counter(r["doc_id"] for r in out.collect())
    want = Counter(r["doc_id"] for r in mixing.draws(docs, entropy=0.9).collect())
    assert got == want and len(got) == len(corpus)


def test_ids_that_are_null_or_repeated_and_empty_tables(spark):
    docs = documents(spark, [(None, "a b", "x"), (1, None, "x"), (1, "", None)])
    assert sorted((r["doc_id"] or 0, r["source"] or "", r["tokens"]) for r in mixing.draws(docs, entropy=0.0).collect()) == [(0, "x", 3), (1, "", 1), (1, "x", 1)]
    assert mixing.draws(documents(spark, [])).count() == 0
    assert mixing.mixed_documents(documents(spark, [])).count() == 0
    one = mixing.draws(documents(spark, [(1, "a", "s"), (2, "b", "s")])).collect()
    assert len(one) == 2 and all(r["weight"] == pytest.approx(1) for r in one)


def test_given_token_counts(spark):
    docs = spark.createDataFrame([(1, "x", "s", 0), (2, "x", "s", None), (3, "x", "t", 5), (4, "x", "u", 0)], "doc_id long, text string, source string, n long")
    rows = mixing.draws(docs, tokens_col="n", entropy=0.0).collect()
    assert [r["doc_id"] for r in rows] == [3]
