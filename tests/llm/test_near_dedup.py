from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyloom.llm import near_dedup
from tallyloom.llm.components import components
from tallyloom.llm.shingles import seeds, shingle_sets
from tests.llm.frames import collected, documents

LOWER = {k: k + 32 for k in range(65, 91)}


def brute_set(text, width=5):
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", (text or "").translate(LOWER)) if w]
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def smallest(nodes, links):
    root = {n: n for n in nodes}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {n: top(n) for n in nodes}


def brute(rows, percent=85):
    sets = {d: brute_set(t) for d, t in rows}
    where = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            where[x].append(d)
    links = []
    for d, s in sets.items():
        common = Counter(e for x in s for e in where[x] if e > d)
        links += [(d, e) for e, c in common.items() if 100 * c >= percent * (len(s) + len(sets[e]) - c)]
    return sets, smallest(sets, links)


def edited(words, n):
    words = list(words)
    for _ in range(n):
        words[random.randrange(len(words))] = f"w{random.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def family():
    """A base text with many edits of different strength, its copies, and unrelated texts."""
    random.seed(11)
    base = [f"b{i}" for i in range(220)]
    rows = [(i, edited(base, random.choice([0, 0, 1, 2, 3, 4, 6, 9]))) for i in range(0, 120)]
    rows += [(i, edited([f"c{j}" for j in range(60)], random.choice([0, 1, 2]))) for i in range(120, 150)]
    rows += [(i, " ".join(f"r{random.randrange(5000)}" for _ in range(random.choice([1, 4, 5, 6, 80])))) for i in range(150, 200)]
    return rows


@pytest.mark.parametrize("small, block", [(32, 500_000), (1, 2_000)])
def test_same_as_brute_force(spark, family, monkeypatch, small, block):
    monkeypatch.setattr(near_dedup.node_links, "__defaults__", (small, block))
    sets, groups = brute(family)
    got = collected(near_dedup.near_duplicates(documents(spark, family).repartition(5)))
    for d, s in sets.items():
        assert (got[d]["n_shingles"], got[d]["component_id"], got[d]["kept"]) == (len(s), groups[d], groups[d] == d)


def test_words_and_short_texts(spark):
    rows = [
        (1, "One TWO three"), (2, "one\ttwo\nthree"), (3, None), (4, ""), (5, " \n"), (6, "a b c d e"), (7, "A b c d  e "),
        (8, "É é"), (9, "é é"), (10, "one two three"), (11, "a a a a a a a a"),
    ]
    sets, groups = brute(rows)
    got = collected(near_dedup.near_duplicates(documents(spark, rows)))
    assert {d: (r["n_shingles"], r["component_id"]) for d, r in got.items()} == {d: (len(sets[d]), groups[d]) for d, _ in rows}
    assert got[2]["component_id"] == 1 and not got[2]["kept"] and got[3]["kept"] and got[8]["component_id"] == 8


def test_ids_that_are_null_or_repeated(spark):
    rows = [(9, "p q r s t u"), (9, "k l m n o"), (4, "k l m n o"), (3, "p q r s t u"), (None, "k l m n o")]
    out = near_dedup.near_duplicates(documents(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in out) == [
        (0, 0, True), (3, 3, True), (4, 3, False), (9, 3, False), (9, 3, False)]


def test_empty_table_and_columns(spark):
    docs = documents(spark, [])
    assert near_dedup.near_duplicates(docs).count() == 0
    docs = documents(spark, [(1, "a b c d e f"), (2, "a b c d e f"), (3, "other words are in here")])
    out = near_dedup.deduplicated(docs)
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == [1, 3]


def test_sketch_fills_and_estimates():
    t = 252
    salts = seeds(2 * t, 5)
    for n in (1, 2, 7, 100, 5000):
        own = near_dedup.sketch(np.sort(seeds(n, 77)), t, salts)
        assert len(own) == t and (own != 0).all()
    all_items = seeds(2000, 99)
    for shared in (1000, 1700):
        a, b = np.sort(all_items[:1850]), np.sort(all_items[1850 - shared : 1850 - shared + 1850] if shared < 1850 else all_items)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        seen = (near_dedup.sketch(a, t, salts) == near_dedup.sketch(b, t, salts)).mean()
        assert abs(seen - true) < 0.12


def test_shingles_do_not_cross_texts():
    texts = ["a b c d e f", "", "c d e f g h", "x"]
    one = shingle_sets([t.encode() for t in texts])
    assert [list(x) for x in one] == [list(shingle_sets([t.encode()])[0]) for t in texts]
    assert [len(x) for x in one] == [2, 0, 2, 1]


def test_components(spark):
    random.seed(2)
    links = [(random.randrange(400), random.randrange(400)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(7, 7)]
    links += [(2000, i) for i in range(2001, 2040)]
    got = collected(components(spark.createDataFrame(links, "a long, b long")), "node")
    want = smallest({x for l in links for x in l}, links)
    assert {n: r["component"] for n, r in got.items()} == {n: c for n, c in want.items() if any(n in l and l[0] != l[1] for l in links)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
