from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tallyloom.llm import mixing, quality
from tallyloom.llm.queries import ORACLES, QUERIES, TOKENIZER
from tests.llm.frames import documents
from tests.llm.test_exact_dedup import brute as equal_texts
from tests.llm.test_near_dedup import brute as near_texts
from tests.oracle import check, connect


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, name):
    _, rows, bad = check(spark, connect(sf_dir), name, QUERIES[name], ORACLES.get(name), sf_dir)
    assert rows and bad is None, bad


def test_each_operator_has_one_query():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_pipeline_like_brute_force(spark, sf_dir):
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}

    score = {r["doc_id"]: r["accepted"] for r in quality.scores(docs, labels).collect()}
    left = {d: t for d, t in texts.items() if score[d]}
    equal = equal_texts(list(left.items()))
    left = {d: t for d, t in left.items() if equal[d][0] == d}
    _, groups = near_texts(list(left.items()), 80)
    left = {d: t for d, t in left.items() if groups[d] == d}
    rest = docs.filter(docs.doc_id.isin(list(left)))
    times = Counter(r["doc_id"] for r in mixing.draws(rest, entropy=0.9, repetitions=4.0).collect())
    assert set(times) == set(left)

    own = Tokenizer.from_file(TOKENIZER)
    lengths = {d: len(own.encode(t, add_special_tokens=False).ids) + 1 for d, t in left.items()}
    want = Counter({(d, k): times[d] for d in left for k in range(-(-lengths[d] // 2048))})
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter((r["doc_id"], r["piece"]) for r in rows) == want
    assert sum(r["length"] for r in rows) == sum(lengths[d] * n for d, n in times.items())
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own_pieces in bins.values():
        ends = np.cumsum([n for _, n in sorted(own_pieces)])
        assert [o for o, _ in sorted(own_pieces)] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_stages_return_the_columns_of_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns
        assert stage(spark, docs.limit(0), sf_dir).count() == 0


def test_near_copies_from_80_percent_are_dropped(spark, sf_dir):
    rows = []
    for i, n in enumerate([48, 49, 50, 55, 60, 61, 62, 63, 64, 70, 100]):
        words = [f"t{i}w{k}" for k in range(n)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join([*words[: n // 2], "changed", *words[n // 2 + 1 :]]))]
    _, groups = near_texts(rows, 80)
    left = corpus_pipeline.drop_near_copies(spark, documents(spark, rows), sf_dir)
    assert {r["doc_id"] for r in left.collect()} == {d for d, g in groups.items() if d == g}
    assert groups[1] == 1 and groups[3] == 2
