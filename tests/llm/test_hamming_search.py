from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import hamming_search
from tests.llm.frames import CLASHING


def frame(spark, rows):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<float>")
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING])


def brute(rows, asked, k):
    out = {}
    codes = {i: np.asarray(v) > 0 for i, v in rows}
    for q in asked:
        found = sorted((int((codes[q] != c).sum()), i) for i, c in codes.items() if i != q)[:k]
        out[q] = [(n + 1, i, d) for n, (d, i) in enumerate(found)]
    return out


def searched(*args, **settings):
    got = {}
    for r in hamming_search.search(*args, **settings).collect():
        got.setdefault(r["vec_id"], []).append((r["rank"], r["neighbor_id"], r["distance"]))
    return {q: sorted(x) for q, x in got.items()}


@pytest.mark.parametrize("bits, segments, code_rows, query_rows", [(16, 4, 200_000, 20_000), (20, 3, 40, 3), (64, 4, 60, 7)])
def test_same_as_brute_force(spark, bits, segments, code_rows, query_rows):
    rng = np.random.default_rng(bits)
    centers = rng.normal(size=(6, bits))
    vectors = [centers[rng.integers(6)] + 0.7 * rng.normal(size=bits) for _ in range(500)]
    vectors += [vectors[0]] * 60 + [vectors[1]] * 5
    rows = list(enumerate(vectors))
    asked = list(range(0, len(rows), 20))
    every = frame(spark, rows).repartition(6)
    got = searched(every, every.filter("vec_id % 20 = 0"), k=7, bits=bits, segments=segments, code_rows=code_rows, query_rows=query_rows)
    assert got == brute(rows, asked, 7)


def test_few_vectors_and_ties(spark):
    rows = [(5, [1, 1, 1, 1]), (3, [1, 1, 1, -1]), (4, [1, 1, -1, 1]), (9, [-1, -1, -1, -1])]
    every = frame(spark, rows)
    assert searched(every, every, k=10, bits=4, segments=2) == brute(rows, [3, 4, 5, 9], 10)
    outside = frame(spark, [(100, [1, 1, 1, 1])])
    assert searched(every, outside, k=2, bits=4, segments=2) == {100: [(1, 5, 0), (2, 3, 1)]}


def test_nulls_and_repeated_rows(spark):
    rows = [(1, [1, 1, 1, 1]), (1, [1, 1, 1, 1]), (2, None), (None, [1, 1, 1, 1]), (3, [1, 1]), (4, [None, float("nan"), 1, 1]), (6, [1, 1, 1, 1])]
    every = frame(spark, rows)
    assert searched(every, every.filter("vec_id = 1"), k=5, bits=4, segments=2) == {1: [(1, 6, 0), (2, 4, 2)]}


def test_empty_tables(spark):
    none, one = frame(spark, []), frame(spark, [(1, [1, 1, 1, 1])])
    for a, b in ((none, none), (one, none), (none, one), (one, one)):
        assert hamming_search.search(a, b, k=3, bits=4, segments=2).count() == 0
    with pytest.raises(ValueError):
        hamming_search.search(one, one, k=3, bits=65)
