from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyloom.llm import phrases, wordstream
from tests.llm.frames import documents

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, support, covered=80, top=2000):
    """Rows of `collocations`, as a set, of rows (lang, text)."""
    counts, words = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            own = counts.setdefault(lang, Counter())
            for k in range(1, 5):
                own.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, f in counts.items():
        often = {g: a for g, a in f.items() if a >= support and len(g) > 1}
        found = []
        for g, a in often.items():
            inside = [b for h, b in often.items() if len(h) > len(g) and any(h[i : i + len(g)] == g for i in range(len(h)))]
            if any(100 * b >= covered * a for b in inside):
                continue
            score, _, l, r = min((2_000_000 * a // (f[g[:k]] + f[g[k:]]), k, f[g[:k]], f[g[k:]]) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), l, r))
        for rank, (score, a, g, l, r) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, g.decode(), -a, l, r, words[lang], -score))
    return out


def corpus(seed, n=150):
    random.seed(seed)
    kinds = ["the", "OF", "und", "é", "ß", "a", "b", "New", "york", "city", "x1", "-", "日本"]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(random.randrange(25)):
            parts.append(random.choice(kinds + ["New York City hall", "a a a a", "x1 - x1"]))
            parts.append(random.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "!?", "\xa0"]))
        rows.append((i, "".join(parts), "s", random.choice(["en", "de", None, ""])))
    return rows + [(1000, None, "s", "en"), (1001, "", "s", "xx"), (1002, "lonely words", "s", "yy")]


@pytest.mark.parametrize("support, shard", [(30, 1 << 20), (5, 600), (2, 4000), (40, 3000)])
def test_same_as_brute_force(spark, support, shard):
    rows = corpus(support)
    got = phrases.collocations(documents(spark, rows).repartition(3), support=support, shard_bytes=shard).collect()
    want = brute([(r[3], r[1]) for r in rows], support)
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_top_and_covered(spark):
    rows = corpus(77)
    got = phrases.collocations(documents(spark, rows), support=4, covered=101, top=3).collect()
    assert {tuple(r) for r in got} == brute([(r[3], r[1]) for r in rows], 4, covered=101, top=3)


def test_no_phrase_is_overlooked_by_all_shards():
    """SON: a phrase that reaches the support is found by some shard at its own threshold."""
    for support in range(1, 60):
        for shards in range(1, 80):
            assert shards * (phrases.local_support(support, shards) - 1) < support


def test_more_shards_than_planned(spark, monkeypatch):
    """Thresholds that are too high for the shards there are: all phrases are counted."""
    monkeypatch.setattr(phrases, "local_support", lambda support, shards: support)
    rows = corpus(5)
    got = phrases.collocations(documents(spark, rows).repartition(3), support=5, shard_bytes=2000).collect()
    assert {tuple(r) for r in got} == brute([(r[3], r[1]) for r in rows], 5)


def test_shards_are_cut_by_bytes():
    import pyarrow as pa

    random.seed(3)
    texts = ["x" * random.randrange(1, 400) for _ in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 500), pa.array(texts)], ["lang", "text"])
    sizes = [len(t) for _, t in phrases._shards(iter([batch.slice(0, 200), batch.slice(200)]), 5000)]
    assert sum(sizes) == sum(map(len, texts)) + 500 and min(sizes) >= 5000 and max(sizes) <= 7500 + 802


def test_words_of_long_texts_do_not_depend_on_blocks(monkeypatch):
    random.seed(2)
    text = "".join(random.choice(["ab", "C", "é", " ", "  ", "\t", ".", "\n", ", "]) for _ in range(20_000)).encode()
    whole = phrases._Shard("en", b"\n".join([text, b"", text[:50], b""]))
    monkeypatch.setattr(wordstream, "BLOCK", 37)
    cut = phrases._Shard("en", b"\n".join([text, b"", text[:50], b""]))
    for name in ("words", "start", "joined"):
        assert (getattr(whole, name) == getattr(cut, name)).all()


def test_empty_table(spark):
    assert phrases.collocations(documents(spark, [])).count() == 0


def test_what_shards_send_grows_with_the_text(spark, monkeypatch):
    """Five times the text makes five times the shards; none of them sends more for there being others."""
    sent = []
    own = phrases._mine

    def watched(*args):
        mine, made = own(*args), sent[-1]

        def run(batches):
            for batch in mine(batches):
                made.add(batch.nbytes)
                yield batch

        return run

    monkeypatch.setattr(phrases, "_mine", watched)
    for n in (20, 100):
        random.seed(6)
        rows = [(i, " ".join(random.choice(["aaa", "bbb", "ccc", "ddd"]) for _ in range(100)), "s", "en") for i in range(n)]
        sent.append(spark.sparkContext.accumulator(0))
        got = phrases.frequent_phrases(documents(spark, rows).repartition(10), support=30, shard_bytes=4000).collect()
        counts = Counter(" ".join(w[i : i + k]) for _, t, _, _ in rows for w in [t.split()] for k in range(1, 5) for i in range(len(w) - k + 1))
        assert {r["phrase"]: r["count"] for r in got if r["size"]} == {p: c for p, c in counts.items() if c >= 30}
    assert 0 < sent[1].value <= 7 * sent[0].value


def test_few_shards_send_the_text_of_a_phrase(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)
    own = phrases._name

    def watched(*args):
        name = own(*args)

        def run(batches):
            for batch in name(batches):
                made.add(batch.num_rows)
                yield batch

        return run

    monkeypatch.setattr(phrases, "_name", watched)
    random.seed(7)
    kinds = [a + b + "x" for a in "abcde" for b in "pqrstu"]
    rows = [(i, " ".join(random.choice(kinds) for _ in range(100)), "s", "en") for i in range(200)]
    got = phrases.frequent_phrases(documents(spark, rows).repartition(20), support=10, shard_bytes=4000).collect()
    counts = Counter(" ".join(w[i : i + k]) for _, t, _, _ in rows for w in [t.split()] for k in range(1, 5) for i in range(len(w) - k + 1))
    want = {p: c for p, c in counts.items() if c >= 10}
    assert {r["phrase"]: r["count"] for r in got if r["size"]} == want
    # About 13 of 20 shards hold each of them.
    assert len(want) <= made.value <= 2 * len(want)


def test_one_shard_sends_the_text_of_a_phrase_that_always_stands_alike(spark, monkeypatch):
    """Copies stand in all shards, among the same words: twice the shards don't send their phrases twice as often."""
    made = []
    own = phrases._name

    def watched(*args):
        name, rows = own(*args), made[-1]

        def run(batches):
            for batch in name(batches):
                rows.add(batch.num_rows)
                yield batch

        return run

    monkeypatch.setattr(phrases, "_name", watched)
    text = " ".join(f"w{i}" for i in range(500))
    for tasks in (10, 20):
        rows = [(i, text, "s", "en") for i in range(2 * tasks)]
        made.append(spark.sparkContext.accumulator(0))
        got = phrases.frequent_phrases(documents(spark, rows).repartition(tasks, "doc_id"), support=10, shard_bytes=1000).collect()
        assert len(got) == 500 + 499 + 498 + 497 + 1
        assert made[-1].value <= 1.1 * len(got)


def test_texts_dealt_anew_in_each_pass(spark):
    """A shard that doesn't hold what it was chosen for: the phrase's text comes from another."""
    anywhere = F.udf(lambda _: random.randrange(1 << 30), "int").asNondeterministic()
    rows = corpus(9)
    docs = documents(spark, rows).withColumn("to", anywhere("doc_id")).repartition(12, "to").drop("to")
    got = phrases.collocations(docs, support=5, shard_bytes=300).collect()
    assert {tuple(r) for r in got} == brute([(r[3], r[1]) for r in rows], 5)
