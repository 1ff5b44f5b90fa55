from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallyloom.llm import packing
from tallyloom.llm.queries import TOKENIZER
from tallyloom.llm.tokens import WordTokenizer
from tests.llm.frames import documents


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(TOKENIZER)


ODD = [
    "", " ", "don't stop, it's 12:30!", "Ünïcödé ß ẞ ŒUVRE ﬁ ½ ²", "a\x1cb\x1d c", "x<|endoftext|>y <|startoftext|>", "<|", " a b　c",
    "é é", "日本語 テスト", "😀 ok👍🏽", "İstanbul ΑΣ Σ", "'s 's's 'tx", "a_b __ --- ...!?", "١٢٣ 4５6", "﻿z​z", "ÀÖØöøÿ÷×ªºµ",
]


def test_words_encode_like_whole_texts(reference):
    random.seed(5)
    pieces = "a B é ß 's ' \" . , ! 7 ² _ - \t \n \x1c   ́ Σ İ ﬁ 日 😀 <|endoftext|> 't 're ll ʼ".split(" ") + [" ", "  "]
    texts = ODD + ["".join(random.choice(pieces) for _ in range(random.randrange(1, 30))) for _ in range(3000)]
    small = WordTokenizer(TOKENIZER, most_parts=50)
    got = [b for k in range(0, len(texts), 40) for b in small.encode(texts[k : k + 40])]
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids, repr(text)


def test_parts_told_apart_by_a_special_token(reference, monkeypatch):
    own = WordTokenizer(TOKENIZER)
    own.ends[:] = False
    for text in ODD + ["don't you're 12ab'll"]:
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == reference.encode(text, add_special_tokens=False).ids


def test_literal_special_tokens(reference):
    literal = Tokenizer.from_file(TOKENIZER)
    literal.encode_special_tokens = True
    own = WordTokenizer(TOKENIZER, literal=True)
    for text in ODD:
        assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == literal.encode(text, add_special_tokens=False).ids


def check_packing(rows, texts, reference, capacity):
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for d, text in texts.items():
        ids = np.array(reference.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        cut = [(k, s, len(ids[s : s + capacity]), zlib.crc32(ids[s : s + capacity].tobytes())) for k, s in enumerate(range(0, len(ids), capacity))]
        assert sorted(pieces[d]) == cut
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins), sum(r["length"] for r in rows)


def test_round_trip(spark, reference):
    random.seed(8)
    texts = {i: " ".join(random.choice(["alpha", "beta's", "x", "é"]) for _ in range(random.choice([1, 3, 20, 90, 300]))) for i in range(150)}
    texts |= {500 + i: t for i, t in enumerate(ODD)} | {900: None, 901: "long " * 1000}
    rows = packing.pack(documents(spark, list(texts.items())).repartition(7), TOKENIZER, capacity=64).collect()
    bins, tokens = check_packing(rows, texts, reference, 64)
    assert bins <= 1.05 * tokens / 64 + 1


def test_many_pieces_of_one_length_are_ranked_in_buckets(spark, reference, monkeypatch):
    monkeypatch.setattr(packing, "_RANKED", 10)
    texts = {i: "word" for i in range(200)} | {i: "two words" for i in range(200, 260)}
    rows = packing.pack(documents(spark, list(texts.items())), TOKENIZER, capacity=8).collect()
    bins, tokens = check_packing(rows, texts, reference, 8)
    assert bins == -(-tokens // 8)


def test_ids_that_are_null_or_repeated_and_empty_tables(spark):
    rows = packing.pack(documents(spark, [(None, "a"), (1, "b"), (1, "b"), (1, None)]), TOKENIZER).collect()
    assert sorted(r["length"] for r in rows) == [1, 2, 2, 2] and len({(r["sequence_id"], r["offset"]) for r in rows}) == 4
    assert packing.pack(documents(spark, []), TOKENIZER).count() == 0


def fewest(sizes, capacity):
    """The least number of bins, by trying all."""
    best = len(sizes)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(sizes):
            best = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + sizes[k] <= capacity:
                place(k + 1, bins[:i] + [bins[i] + sizes[k]] + bins[i + 1 :])
        place(k + 1, bins + [sizes[k]])

    place(0, [])
    return best


def test_plan_is_complete_and_close_to_the_best():
    random.seed(4)
    for _ in range(40):
        sizes = sorted((random.randrange(1, 21) for _ in range(9)), reverse=True)
        counts = {s: sizes.count(s) for s in sizes}
        bins = packing.plan(counts, 20)
        used = defaultdict(int)
        for times, own in bins:
            assert sum(k * n for k, n in own.items()) <= 20
            for k, n in own.items():
                used[k] += n * times
        assert dict(used) == counts
        assert sum(times for times, _ in bins) <= fewest(sizes, 20) + 1


def test_fullest_finds_the_best_sum():
    random.seed(6)
    for _ in range(60):
        left = {random.randrange(1, 30): random.randrange(1, 4) for _ in range(5)}
        space = random.randrange(1, 60)
        sums = {0}
        for k, n in left.items():
            sums = {s + k * m for s in sums for m in range(n + 1) if s + k * m <= space}
        found = packing.fullest(space, left)
        assert sum(k * n for k, n in found.items()) == max(sums) and all(n <= left[k] for k, n in found.items())
