from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from tallyloom.operators import changes

SCHEMA = "k long, a string, b double"


def frames(spark, before, after):
    return spark.createDataFrame(before, SCHEMA), spark.createDataFrame(after, SCHEMA)


def test_cells_rows_and_nulls(spark):
    before, after = frames(
        spark, [(1, "x", 1.0), (2, "y", None), (3, None, 3.0), (None, "n", 0.0), (5, "same", -0.0)],
        [(1, "x", 2.0), (2, None, 5.0), (4, "new", 4.0), (None, "m", 0.0), (5, "same", 0.0)])
    found = {(r["k"], r["change"], r["column"], r["before"], r["after"]) for r in changes.table_changes(before, after, ["k"]).collect()}
    assert found == {
        (1, "changed", "b", "1.0", "2.0"), (2, "changed", "a", "y", None), (2, "changed", "b", None, "5.0"),
        (3, "removed", None, None, None), (4, "added", None, None, None), (None, "changed", "a", "n", "m")}


def test_counts_of_a_key_with_many_rows(spark):
    """Every copy is paired once, also where one key holds nearly all rows."""
    random.seed(1)
    old = [(7, random.choice("abcdef"), float(random.randrange(50))) for _ in range(3000)] + [(8, "q", 1.0)] * 5
    new = [(7, random.choice("bcdefg"), float(random.randrange(50))) for _ in range(3500)] + [(8, "q", 1.0)] * 2
    before, after = frames(spark, old, new)
    rows = changes.table_changes(before, after, ["k"]).collect()
    gone, came = Counter(old) - Counter(new), Counter(new) - Counter(old)
    for k in (7, 8):
        n, m = sum(c for r, c in gone.items() if r[0] == k), sum(c for r, c in came.items() if r[0] == k)
        pairs = {(r["change"], r["pair"]) for r in rows if r["k"] == k}
        assert sum(c == "changed" for c, _ in pairs) == min(n, m)
        assert sum(c == "added" for c, _ in pairs) == max(0, m - n) and sum(c == "removed" for c, _ in pairs) == max(0, n - m)
        assert {p for _, p in pairs} == set(range(1, max(n, m) + 1))
    # The values of the changed cells are those that left and those that came.
    left = Counter(r["before"] for r in rows if r["column"] == "a")
    assert all(left[a] <= sum(c for r, c in gone.items() if r[1] == a) for a in left)


def test_multiset_difference(spark):
    before, after = frames(spark, [(1, "x", 1.0)] * 3 + [(2, None, None)], [(1, "x", 1.0)] + [(2, None, None)] * 2)
    found = {(r["k"], r["a"], r["before"], r["after"]) for r in changes.row_changes(before, after).collect()}
    assert found == {(1, "x", 3, 1), (2, None, 1, 2)}


def test_maps_arrays_and_other_names(spark):
    base = spark.range(3).select(F.col("id").alias("the key"), F.create_map(F.lit("a"), F.col("id")).alias("m.p"), F.array("id").alias("_c0"))
    new = base.withColumn("_c0", F.when(F.col("the key") == 1, F.array(F.lit(9).cast("long"))).otherwise(F.col("_c0")))
    rows = changes.table_changes(base, new, ["the key"]).collect()
    assert [(r["the key"], r["column"], r["before"], r["after"]) for r in rows] == [(1, "_c0", "[1]", "[9]")]


def test_equal_and_empty_tables(spark):
    before, after = frames(spark, [(1, "x", 1.0)], [(1, "x", 1.0)])
    assert changes.table_changes(before, after, ["k"]).count() == 0
    assert changes.table_changes(before.limit(0), after.limit(0), ["k"]).count() == 0
    assert [r["change"] for r in changes.table_changes(before, after.limit(0), ["k"]).collect()] == ["removed"]
