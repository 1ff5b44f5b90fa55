from __future__ import annotations

import hashlib
import random
import re

import pytest

from tallyloom.llm import exact_dedup
from tests.llm.frames import collected, documents


def brute(rows):
    """{doc_id: (keep_id, group_size)} of rows (doc_id, text)."""
    groups = {}
    for d, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", "", t or ""), []).append((-len(t or ""), d))
    return {d: (min(g)[1], len(g)) for g in groups.values() for _, d in g}


@pytest.mark.parametrize("bits", [1, 4])
def test_same_as_brute_force_over_many_runs(spark, bits):
    random.seed(3)
    rows = [(i, random.choice(["a b", "ab", " a\tb\n", "c", None, "", " ", "\x0b\x0c\r", "é b", "éb ", "a b"])) for i in range(300)]
    got = collected(exact_dedup.duplicates(documents(spark, rows).repartition(23), bits=bits))
    assert {d: (r["keep_id"], r["group_size"]) for d, r in got.items()} == brute(rows)
    for d, t in rows:
        assert got[d]["kept"] == (got[d]["keep_id"] == d)
        assert got[d]["text_sha256"] == hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", "", t or "").encode()).hexdigest()


def test_longest_original_counts_code_points(spark):
    got = collected(exact_dedup.duplicates(documents(spark, [(1, "😀😀"), (2, "😀 😀"), (3, "😀  😀"), (4, "😀 😀")])))
    assert [got[d]["keep_id"] for d in (1, 2, 3, 4)] == [3, 3, 3, 4]


def test_ids_that_are_null_or_repeated(spark):
    rows = exact_dedup.duplicates(documents(spark, [(None, "a"), (5, "a"), (5, "a"), (None, "lonely")])).collect()
    found = sorted((r["doc_id"] is None, r["keep_id"] or 0, r["group_size"], r["kept"]) for r in rows)
    assert found == [(False, 5, 3, True), (False, 5, 3, True), (True, 0, 1, True), (True, 5, 3, False)]


def test_deduplicated_keeps_columns_and_one_row(spark):
    docs = documents(spark, [(1, "x y"), (2, "xy"), (2, "xy"), (3, "z"), (3, "z"), (None, None)])
    out = exact_dedup.deduplicated(docs)
    assert out.columns == docs.columns
    assert sorted((r["doc_id"] or 0) for r in out.collect()) == [0, 1, 3]


def test_empty_table(spark):
    docs = documents(spark, [])
    assert exact_dedup.duplicates(docs).count() == 0
    assert exact_dedup.deduplicated(docs).count() == 0


def test_merges_neither_shuffle_nor_sort_ranges_again(spark):
    """A round is one exchange by range, one sort and one ordered pass."""
    rows = exact_dedup.digest_rows(documents(spark, [(i, f"t{i % 7}") for i in range(50)]))
    entries = exact_dedup.checkpointed(exact_dedup.merge_runs(rows).selectExpr("0L run", "*").selectExpr(
        "run", "digest", "check", "size", "struct(0 as shorter, false as unnamed, keep as id) as best", "members"))
    plan = exact_dedup._merged(entries, 2)._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("+- == Initial Plan ==")[-1]
    assert plan.count("Exchange rangepartitioning") == 1 and plan.count("Exchange hashpartitioning") == 0
    assert plan.count("SortAggregate") == 2 and plan.count("+- Sort ") == 1


def test_digests_of_different_texts_are_kept_apart_and_counted(spark):
    merged = spark.createDataFrame([(b"a", 1, 3), (b"a", 2, 3), (b"b", 1, 1)], "digest binary, check long, size int")
    assert exact_dedup.disagreements(merged) == 1


def test_columns_with_any_names_stay(spark):
    docs = documents(spark, [(1, "x y"), (2, "xy"), (2, "xy")]).selectExpr("*", "1 as _tl_text", "2 as copies", "3 as digest2")
    out = exact_dedup.deduplicated(docs)
    assert out.columns == docs.columns and out.count() == 1


def test_long_texts(spark):
    long = "ab c " * 400_000
    got = collected(exact_dedup.duplicates(documents(spark, [(1, long), (2, long.replace(" ", "")), (3, long + "d")])))
    assert [(got[d]["keep_id"], got[d]["group_size"]) for d in (1, 2, 3)] == [(1, 2), (1, 2), (3, 1)]
