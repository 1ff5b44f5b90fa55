from __future__ import annotations

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallyloom.llm import token_scan
from tallyloom.llm.queries import END_OF_TEXT, TOKENIZER
from tests.llm.frames import documents


@pytest.mark.parametrize("size, span", [(4, 2), (7, 3), (1 << 20, 1024)])
def test_documents_cross_ranges(spark, tmp_path, size, span):
    random.seed(size)
    want = {}
    for name, tail in (("a.bin", 0), ("b.bin", 5), ("c.bin", 0), ("empty.bin", 0)):
        lengths = [random.choice([0, 0, 1, 3, 20]) for _ in range(40)] if name in ("a.bin", "b.bin") else [0] if name == "c.bin" else []
        ids = []
        for n in lengths:
            ids += [*range(1, n + 1), 0]
        np.array(ids + [9] * tail, "<u4").tofile(tmp_path / name)
        starts = np.cumsum([0] + [n + 1 for n in lengths])
        want[name] = [(k, int(starts[k]), n, True) for k, n in enumerate(lengths)]
        if tail:
            want[name].append((len(lengths), len(ids), tail, False))
    files = token_scan.files_of(spark, str(tmp_path))
    got = {name: [] for name in want}
    for r in token_scan.document_lengths(files, 0, size, span).collect():
        got[r["file"].rsplit("/", 1)[1]].append((r["place"], r["start"], r["n_tokens"], r["closed"]))
    assert {k: sorted(v) for k, v in got.items()} == want


def test_bytes_after_the_last_id_are_ignored(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(np.array([5, 0], "<u4").tobytes() + b"\x01\x02")
    rows = token_scan.document_lengths(token_scan.files_of(spark, str(tmp_path)), 0).collect()
    assert [(r["place"], r["n_tokens"], r["closed"]) for r in rows] == [(0, 1, True)]


@pytest.mark.parametrize("id_bytes", [2, 4])
def test_counts_of_documents(spark, id_bytes):
    own = Tokenizer.from_file(TOKENIZER)
    own.encode_special_tokens = True
    texts = {1: "hello world", 2: None, 3: "", 4: "a <|endoftext|> b", 5: "x " * 3000, 6: "ß é"}
    rows = token_scan.token_counts(documents(spark, list(texts.items())).repartition(3), TOKENIZER, END_OF_TEXT, size=64, id_bytes=id_bytes).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == {d: len(own.encode(t or "", add_special_tokens=False).ids) for d, t in texts.items()}


def test_ids_that_are_null_or_repeated_and_empty_tables(spark):
    rows = token_scan.token_counts(documents(spark, [(None, "a"), (1, "b b"), (1, "b b b")]), TOKENIZER, END_OF_TEXT).collect()
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in rows) == [(0, 1), (1, 2), (1, 3)]
    assert token_scan.token_counts(documents(spark, []), TOKENIZER, END_OF_TEXT).count() == 0
