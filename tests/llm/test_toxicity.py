from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tallyloom.llm import toxicity
from tallyloom.llm.lexicon import Matcher
from tests.llm.frames import collected, documents


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def brute_match(word, entries):
    found = []
    for term, (edits, stem) in entries.items():
        e = min(distance(word[:k], term) for k in range(len(word) + 1)) if stem else distance(word, term)
        if e <= edits:
            found.append((e, -len(term), term))
    return (min(found)[2], min(found)[0]) if found else None


def test_automaton_agrees_with_edit_distance():
    random.seed(13)
    entries = {"abba": (1, False), "abc": (0, False), "bacab": (2, False), "cabba": (1, True), "ccc": (0, True), "abbab": (1, False)}
    own = Matcher(entries, remembered=60)
    words = {"".join(random.choice("abc") for _ in range(random.randrange(0, 9))) for _ in range(3000)}
    for word in words:
        assert own.match(word) == brute_match(word, entries), word


def labelled(n):
    """Documents where the invented insults `grobnik` and words from `vrax` are toxic."""
    random.seed(14)
    rows, marks = [], []
    for i in range(n):
        words = [f"w{chr(97 + random.randrange(26))}{chr(97 + random.randrange(26))}x{chr(97 + random.randrange(26))}" for _ in range(random.randrange(8, 60))]
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                words.insert(random.randrange(len(words)), random.choice(["grobnik", "vrax" + random.choice("abcdefgh") * 2, "Grobnik!"]))
        rows.append((i, " ".join(words)))
        marks.append((i, int(bad)))
    return rows, marks


@pytest.fixture(scope="module")
def scored(spark):
    rows, marks = labelled(900)
    extra = [
        (5000, "you are such a grobnik and a grobnyk wax wbx"), (5001, 'the word "grobnik" is an insult they said, wax wbx wcx wdx'),
        (5002, None), (5003, ""), (5004, "wax " * 40_000), (5005, "wax grobmik wbx grobnikk"), (None, "wax"), (7, "wax"), (7, "wax"),
    ]
    named = spark.createDataFrame(marks + [(None, 1), (9999, 1), (8, None)], "doc_id long, toxic int")
    out = toxicity.scores(documents(spark, [r for r in rows if r[0] != 7] + extra).repartition(4), named)
    return out.collect(), dict(marks)


def test_held_out_documents(scored):
    got, marks = scored
    held = [(r["predicted"], marks[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in marks and r["doc_id"] != 7]
    assert len(held) > 200
    assert np.mean([p for p, m in held if m]) > 0.97 and np.mean([p for p, m in held if not m]) < 0.01


def test_held_out_follows_the_id(scored):
    for r in scored[0]:
        d = r["doc_id"]
        assert r["held_out"] == (d is not None and zlib.crc32(str(d).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)


def test_misspelling_and_quotation(scored):
    score = {r["doc_id"]: r["score"] for r in scored[0]}
    assert score[5000] > 0.9 and score[5001] < score[5000] and score[5005] > 5 * score[5003]
    assert score[5002] == score[5003] < 0.3 and score[5004] < 0.3


def test_copies_do_not_make_terms(spark):
    rows, marks = labelled(300)
    copies = [(1000 + i, rows[1][1] + " zebrazebra") for i in range(60)]
    df = spark.createDataFrame([(t, m) for (_, t), (_, m) in zip(rows, marks)] + [(t, 1) for _, t in copies], "text string, label int")
    terms = toxicity.learn_lexicon(df).terms
    assert "grobnik" in terms and "zebrazebra" not in terms


def test_quoted_hits_count_less():
    reader = toxicity.Reader(toxicity.Lexicon({"grobnik": (0.9, 0.45, False)}))
    plain, quoted = reader.features("he is a grobnik today"), reader.features('he is a "grobnik" today')
    assert quoted[0] < plain[0] < reader.features("you are a grobnik today")[0]
    assert reader.features("he is fine today")[5] == 0


def test_without_labels_and_empty_tables(spark):
    docs = documents(spark, [(1, "a"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert all(0 <= r["score"] <= 1 for r in toxicity.scores(docs, none).collect())
    assert toxicity.scores(documents(spark, []), none).count() == 0


def test_scores_do_not_depend_on_held_out_labels(spark):
    rows, marks = labelled(200)
    flipped = [(d, 1 - m if zlib.crc32(str(d).encode()) % 3 == 1 else m) for d, m in marks]
    one, two = (collected(toxicity.scores(documents(spark, rows), spark.createDataFrame(m, "doc_id long, toxic int"))) for m in (marks, flipped))
    assert all(abs(one[d]["score"] - two[d]["score"]) < 1e-9 for d in one)


def test_digits_and_symbols_within_words_are_edits():
    reader = toxicity.Reader(toxicity.Lexicon({t: (0.9, 0.45, False) for t in ("idiot", "stupid", "clown")}))
    for form in ("id1ot", "(Id!ot),", "st*pid", "cl_own", "st\u00b7upid"):
        assert reader.features(f"he is {form} today")[5] == 1, form
    for form in ("1d10t", "id-est", "st.paul", "42", "--", "cl_o_w_n"):
        assert reader.features(f"he is {form} today")[5] == 0, form


def test_a_clean_neighbour_does_not_switch_off_the_others(spark):
    rows, marks = labelled(300)
    clean = [f"{a} grobnit {b}" for a in "pqrstu" for b in "pq"] + ["p grobnil q"]
    df = spark.createDataFrame([(t, m) for (_, t), (_, m) in zip(rows, marks)] + [(t, 0) for t in clean], "text string, label int")
    reader = toxicity.Reader(toxicity.learn_lexicon(df))
    assert reader.features("he is grobnit today")[5] == 0
    assert reader.features("he is grobnok today")[0] == reader.features("he is grobnil today")[0] > 0.4


def test_short_terms_words_beside_stems_and_many_terms(spark):
    insults = ["zog", "傻瓜", "scum", "scumbag"]
    names = [a + b for a in "klmnopqrst" for b in "abcdef"]
    rows = [(f"{a} {w} here", 1) for w in insults for a in names] + [(f"{a} fine {b}", 0) for a in names for b in names[:10]]
    terms = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, label int")).terms
    assert {"zog", "傻瓜"} <= set(terms) and toxicity.Reader(toxicity.Lexicon(terms)).features("a scumbag here")[0] > 0.8
    counts = [("scum", False, 90, 0), ("scumbag", False, 60, 0), ("scumb", True, 60, 0), ("clow", True, 80, 0), ("clown", False, 50, 0)]
    counts += [(f"t{i}", False, 40, 0) for i in range(1000)]
    terms = toxicity.learn_terms(toxicity.pd.DataFrame(counts, columns=["term", "stem", "toxic", "other"]), 5000, 5000)
    assert set(terms) == {"scum", "scumbag", "clow", *(f"t{i}" for i in range(1000))}


def test_many_weak_hits_and_long_pieces_have_no_switch():
    lexicon = toxicity.Lexicon({"idiot": (0.02, 0.01, True)}, {})
    joined = [toxicity.Reader(lexicon).features("idiot " * n)[1] for n in (198, 199, 200, 201)]
    steps = [b - a for a, b in zip(joined, joined[1:])]
    assert all(0 < s < 0.01 for s in steps)
    reader = toxicity.Reader(lexicon)
    unspaced = "日本" * 200 + "idiot" + "語" * 100
    assert reader.features(unspaced) == reader.features(unspaced) and all(len(c) <= toxicity.HELD for c in reader.known)


def test_tasks_hold_a_bounded_number_of_contexts(spark):
    """However many texts a batch has, a frame holds few rows; the frames together are the contexts of all texts."""

    class Rows:
        def mapInPandas(self, make, schema):
            self.make = make
            return self

        def distinct(self):
            return self

    rows = [(" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + j % 26)}{chr(97 + j // 26)}word" for j in range(300)), i % 2) for i in range(200)]
    batch = toxicity.pd.DataFrame(rows, columns=["text", "label"])
    frames = list(toxicity._candidates(Rows()).make(iter([batch])))
    got = {tuple(r) for f in frames for r in f.itertuples(index=False)}
    assert max(map(len, frames)) <= 100_000 and sum(map(len, frames)) > 200_000
    found = toxicity._candidates(spark.createDataFrame(rows, "text string, label int")).collect()
    assert len(found) == len(got) and {tuple(r) for r in found} == got
