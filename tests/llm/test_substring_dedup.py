from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from tallyloom.llm import substring_dedup as dedup
from tests.llm.frames import collected, documents


def brute(rows, width):
    """{doc_id: (n_words, n_removed, kept)} by counting all windows."""
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    seen = Counter(tuple(w[i : i + width]) for _, w in words for i in range(len(w) - width + 1))
    out = {}
    for d, w in words:
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        out[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def got(spark, rows, width, parts=5):
    out = dedup.without_duplicates(documents(spark, rows).repartition(parts), width=width)
    return {d: tuple(r)[1:] for d, r in collected(out).items()}


def prose(n, kinds):
    return " ".join(f"w{random.randrange(kinds)}" for _ in range(n))


def corpus(seed, kinds):
    """Texts with shared passages at all places, copies, near copies, periods, NULL and empty texts."""
    random.seed(seed)
    passages = [prose(random.randrange(8, 60), kinds) for _ in range(12)]
    rows = []
    for d in range(120):
        parts = [prose(random.randrange(0, 30), kinds)]
        for _ in range(random.randrange(3)):
            p = random.choice(passages).split()
            a = random.randrange(len(p))
            parts += [" ".join(p[a : a + random.randrange(1, 50)]), prose(random.randrange(0, 6), kinds)]
        rows.append((d, random.choice([" ", "\n", "\t ", "\x0b"]).join(parts)))
    rows += [(200 + i, passages[0] + " " + passages[1]) for i in range(5)]
    near = prose(300, kinds).split()
    for i in range(6):
        own = list(near)
        for _ in range(3):
            own[random.randrange(300)] = f"x{i}"
        rows.append((300 + i, " ".join(own)))
    return rows + [(400, None), (401, ""), (402, " \n"), (403, "ha " * 90), (404, "la di " * 50), (405, "é" + " " + "ü ö")]


@pytest.mark.parametrize("width, kinds", [(35, 5000), (12, 3), (12, 500), (9, 2), (5, 40), (1, 50)])
def test_same_as_brute_force(spark, width, kinds):
    rows = corpus(width * 1000 + kinds, kinds)
    assert got(spark, rows, width) == brute(rows, width)


def test_given_documents_as_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {d: tuple(r)[1:] for d, r in collected(dedup.without_duplicates(docs)).items()}
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert out == brute(rows, 35) and sum(n for _, n, _ in out.values()) > 0


def test_long_texts_in_many_blocks(spark, monkeypatch):
    random.seed(9)
    shared = prose(400, 9000)
    rows = [(1, prose(30_000, 9000) + " " + shared + " " + prose(20_000, 9000)), (2, shared), (3, shared[100:] + " " + prose(600, 9000))]
    from tallyloom.llm import wordstream

    want = brute(rows, 35)
    assert got(spark, rows, 35) == want
    # The same parse with blocks that cut the texts at many places.
    texts = [t.encode() for _, t in rows]
    whole, cuts = wordstream.hashes(texts)
    monkeypatch.setattr(wordstream, "BLOCK", 1000)
    again, same = wordstream.hashes(texts)
    assert (whole == again).all() and (cuts == same).all()


def test_windows_of_a_text_over_a_million_words(spark):
    random.seed(10)
    middle = prose(60, 10**6)
    text = prose(300_000, 10**6) + " " + middle + " " + prose(300_000, 10**6)
    rows = [(1, text), (2, middle), (3, "q " + " ".join(text.split()[dedup._WINDOWS - 20 : dedup._WINDOWS + 30]) + " q")]
    out = got(spark, rows, 35)
    assert [out[d][1] for d in (1, 2, 3)] == [110, 60, 50]


def test_spans_and_repeated_rows(spark):
    random.seed(4)
    a, b = prose(50, 900), prose(40, 900)
    rows = [(1, f"x y {a} z {b}"), (2, a), (2, a), (None, b), (5, None)]
    spans = dedup.duplicate_spans(documents(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, r["first_word"], r["n_words"], r["text"]) for r in spans) == sorted(
        [(1, 2, 50, a), (1, 53, 40, b), (2, 0, 50, a), (2, 0, 50, a), (0, 0, 40, b)])


def test_empty_table(spark):
    assert dedup.without_duplicates(documents(spark, [])).count() == 0
    assert dedup.duplicate_spans(documents(spark, [])).count() == 0
