"""Removal of passages that stand elsewhere too, by relative Lempel-Ziv parsing of all documents against all documents.

The reference is the whole table, and its index is spread over blocks by content. The anchor of a window of `width` words
is the run of `ANCHOR` words in it with the least hash; neighbouring windows with the same anchor make one phrase, and
a phrase belongs to the index block of its anchor's hash. Equal windows have equal anchors, so a document need only be
factored against the blocks of its own anchors: no other block of the index can hold one of its windows.

Factoring is greedy. A phrase whose anchor the index knows once is a literal. A phrase that the index knows whole is
taken whole, and a factor goes on for as long as phrase after phrase is known. At a factor's ends stand phrases whose
anchor is known but in other surroundings; those alone are checked window by window, against the windows of all phrases
of their anchor, so that a factor ends at the very word where the copy ends, and a passage shorter than a phrase is not
lost. Every factor has `width` words or more and becomes a duplicate span.

The parse is exact but for collisions of two 64-bit hashes at once. Equal texts are parsed once. Rows of one anchor,
phrase or window are counted in parts before they are sent, and dealt to `SALTS` tasks when the counts come back to
them, so a passage that a third of all documents hold is no hot key. Texts are hashed in blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import wordstream
from tallyloom.llm.shingles import mixed, seeds
from tallyloom.llm.tables import columns_of, stored, whole

WIDTH = 35
#: Words of an anchor.
ANCHOR = 8
#: Tasks that the rows of one key are dealt to.
SALTS = 16
#: Bytes of text that are parsed at a time, and windows of a longer text.
_BYTES, _WINDOWS = 1 << 20, 1 << 18


def _least(values: np.ndarray, length: int) -> np.ndarray:
    """The place of the leftmost least of each `length` neighbours."""
    best, place, reach = values, np.arange(len(values)), 1
    while reach < length:
        step = min(reach, length - reach)
        a, b = best[:-step], best[step:]
        left = a <= b
        best, place = np.where(left, a, b), np.where(left, place[:-step], place[step:])
        reach += step
    return place


def _phrases(words: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(first window, last window, anchor, phrase) of every phrase; ends[i] is where the text of word i ends."""
    if len(words) < width:
        return tuple(np.empty(0, t) for t in (np.int64, np.int64, np.uint64, np.uint64))
    size = min(ANCHOR, width)
    factors = seeds(size, 41) | np.uint64(1)
    grams = np.zeros(len(words) - size + 1, dtype=np.uint64)
    for k in range(size):
        grams += words[k : k + len(grams)] * factors[k]
    grams = mixed(grams)
    place = _least(grams, width - size + 1)
    start = np.flatnonzero(np.arange(len(place)) + width <= ends[: len(place)])
    if not len(start):
        return _phrases(words[:0], ends[:0], width)
    place = place[start]
    first = np.concatenate([[True], (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)])
    at = np.flatnonzero(first)
    low, high = start[at], start[np.concatenate([at[1:], [len(start)]]) - 1]
    return low, high, grams[place[at]], wordstream.spans(wordstream.sums(words), low, high + width)


def _parsed_text(words: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """The phrases of one text, cut after each `_WINDOWS` windows."""
    parts = []
    for at in range(0, max(1, len(words) - width + 1), _WINDOWS):
        own = words[at : at + _WINDOWS + width - 1]
        low, high, anchor, phrase = _phrases(own, np.full(len(own), len(own)), width)
        parts.append((low + at, high + at, anchor, phrase))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _blocks(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """(from, to) of texts that together have a block's worth of bytes, or of one longer text."""
    at = size = 0
    for i, text in enumerate(texts):
        if i > at and size + len(text) > _BYTES:
            yield at, i
            at, size = i, 0
        size += len(text)
    if at < len(texts):
        yield at, len(texts)


def _lists(values: np.ndarray, cuts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(values, kind))


def _parse(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() for t in batch.column(2).to_pylist()]
            for a, b in _blocks(texts):
                words, cuts = wordstream.hashes(texts[a:b])
                if b - a == 1:
                    low, high, anchor, phrase = _parsed_text(words, width)
                    owner = np.zeros(len(low), dtype=np.int64)
                else:
                    counts = np.diff(cuts)
                    low, high, anchor, phrase = _phrases(words, np.repeat(cuts[1:], counts), width)
                    owner = np.searchsorted(cuts, low, side="right") - 1
                low, high = low - cuts[owner], high - cuts[owner]
                each = np.bincount(owner, minlength=b - a)
                held = np.flatnonzero(each)
                if not len(held):
                    continue
                ends = np.concatenate([[0], np.cumsum(each[held])])
                key = batch.slice(a, b - a).take(pa.array(held))
                yield pa.RecordBatch.from_arrays(
                    [key.column(0), key.column(1), _lists(low.astype(np.int32), ends, pa.int32()), _lists(high.astype(np.int32), ends, pa.int32()),
                     _lists(anchor.view(np.int64), ends, pa.int64()), _lists(phrase.view(np.int64), ends, pa.int64())],
                    ["k1", "k2", "low", "high", "anchor", "phrase"])

    return parse


def _windows(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(id, start, anchor, window, open) of every window of the phrases that are to be checked."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for i, text in enumerate(batch.column(1).to_pylist()):
                words, _ = wordstream.hashes([text.encode()])
                wanted = batch.column(2)[i].values
                low, high, anchor = (wanted.field(k).to_numpy(zero_copy_only=False) for k in range(3))
                check = wanted.field(3).to_numpy(zero_copy_only=False)
                order = np.argsort(low)
                for at in range(0, len(words), _WINDOWS):
                    own = order[(low[order] >= at) & (low[order] < at + _WINDOWS)]
                    if not len(own):
                        continue
                    last = int(high[own].max()) + width
                    running = wordstream.sums(words[at:last])
                    sizes = high[own] - low[own] + 1
                    which = np.repeat(np.arange(len(own)), sizes)
                    start = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[own][which]
                    window = wordstream.spans(running, start - at, start - at + width)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(start), ids[i])), pa.array(start.astype(np.int32)), pa.array(anchor[own][which]),
                         pa.array(window.view(np.int64)), pa.array(check[own][which])], ["id", "low", "anchor", "window", "open"])

    return emit


def _tallied(rows: DataFrame, keys: list[str], parts: list[Column], totals: list[Column], found: Column) -> DataFrame:
    """The rows of the keys for which `found` holds, with the key's totals.

    Counts are made for each key and salt, then for each key, and come back to the rows by key and salt.
    """
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("id", "low"), F.lit(SALTS)).cast("tinyint"))
    part = rows.groupBy(*keys, "salt").agg(*parts)
    total = part.groupBy(*keys).agg(*totals).filter(found)
    return rows.join(part.select(*keys, "salt").join(total, keys), [*keys, "salt"]).drop("salt")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = columns_of(docs, id=id_col, text=text_col).select("id", whole("text").alias("text"))
    return rows.select("id", "text", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(5), "text").alias("k2"))


def _spans(docs: DataFrame, id_col: str, text_col: str, width: int) -> tuple[DataFrame, DataFrame]:
    """(documents with their keys, (k1, k2, spans) of the texts that have duplicate spans)."""
    keyed = _keyed(docs, id_col, text_col)
    phrases = keyed.select("k1", "k2", "text").mapInArrow(
        _parse(width), "k1 long, k2 long, low array<int>, high array<int>, anchor array<long>, phrase array<long>")
    once = phrases.groupBy("k1", "k2").agg(F.count("*").alias("copies"), F.first(F.struct("low", "high", "anchor", "phrase")).alias("p"))
    parsed = stored(once.select(
        F.monotonically_increasing_id().alias("id"), "k1", "k2", F.least("copies", F.lit(2)).alias("w"), "p.*"), "parsed")
    names = parsed.select("id", "k1", "k2")

    rows = parsed.select("id", "w", F.inline(F.arrays_zip("low", "high", "anchor", "phrase")))
    # A known anchor that always stands in the same phrase: a whole phrase of a factor.
    known = stored(_tallied(
        rows, ["anchor"], [F.sum("w").alias("w"), F.min("phrase").alias("a"), F.max("phrase").alias("b")],
        [(F.min("a") == F.max("b")).alias("alone"), F.sum("w").alias("times")], F.col("times") >= 2), "known")
    # Other phrases of known anchors: whole where the phrase is known too, else the end of a factor.
    several = stored(_tallied(
        known.filter("not alone").select("id", "low", "high", "anchor", "phrase", "w"), ["anchor", "phrase"],
        [F.sum("w").alias("w"), F.min("id").alias("one")], [F.sum("w").alias("n"), F.min("one").alias("one")], F.lit(True)), "several")
    ends = several.filter("n = 1 or id = one").groupBy("id").agg(
        F.collect_list(F.struct("low", "high", "anchor", (F.col("n") == 1).alias("open"))).alias("ends"))
    texts = keyed.select("k1", "k2", "text").join(ends.join(names, "id"), ["k1", "k2"])
    windows = texts.select("id", "text", "ends").mapInArrow(
        _windows(width), "id long, low int, anchor long, window long, open boolean")
    checked = _tallied(
        stored(windows, "windows"), ["anchor", "window"], [F.count("*").alias("n")], [F.sum("n").alias("n")], F.col("n") >= 2)

    spans = known.filter("alone").select("id", "low", "high").unionByName(
        several.filter("n >= 2").select("id", "low", "high")).unionByName(
        checked.filter("open").select("id", "low", F.col("low").alias("high")))
    spans = spans.groupBy("id").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    return keyed, stored(spans.join(names, "id").select("k1", "k2", "spans"), "spans")


def _merged(spans: pa.Scalar, width: int) -> list[tuple[int, int]]:
    """(from, to) of the words covered by windows low to high, in order; factors that meet are one."""
    if not spans.is_valid:
        return []
    low = spans.values.field(0).to_numpy(zero_copy_only=False)
    order = np.argsort(low, kind="stable")
    low, end = low[order], np.maximum.accumulate(spans.values.field(1).to_numpy(zero_copy_only=False)[order] + width)
    first = np.concatenate([[True], low[1:] > end[:-1]])
    return list(zip(low[first].tolist(), end[np.concatenate([first[1:], [True]])].tolist()))


def _with_spans(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    keyed, spans = _spans(docs, id_col, text_col, width)
    return keyed.join(spans, ["k1", "k2"], "left").select("id", "text", "spans")


def duplicate_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(id, first_word, n_words, text): the passages of each document whose every word lies in a window that stands elsewhere.

    Words are runs of characters other than space and 0x09-0x0D. Elsewhere is any other place, in the same document too;
    a repeated row is another place. Texts that are NULL, empty or shorter than `width` words have no spans.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, a, b - a, b" ".join(words[a:b]).decode())
                    for i, (text, spans) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2)))
                    for words in [text.encode().split()] for a, b in _merged(spans, width)]
            which, first, size, texts = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(which, pa.int64())), pa.array(first, pa.int64()), pa.array(size, pa.int64()), pa.array(texts, pa.string())],
                ["id", "first_word", "n_words", "text"])

    rows = _with_spans(docs, id_col, text_col, width).filter("spans is not null")
    return rows.mapInArrow(cut, f"id {rows.schema['id'].dataType.simpleString()}, first_word long, n_words long, text string").withColumnRenamed("id", id_col)


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """(id, n_words, n_removed, kept): every document's words that lie in no duplicate span, joined by one space.

    All rows come back, those with nothing left too; windows are judged on the input. A NULL text has no words. Further
    columns are ignored, and an empty table gives no rows.
    """
    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2)):
                words = text.encode().split()
                counts.append(len(words))
                out, at = [], 0
                for a, b in _merged(spans, width):
                    out += words[at:a]
                    at = b
                out += words[at:]
                removed.append(len(words) - len(out))
                kept.append(b" ".join(out).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.large_string()).cast(pa.string())],
                ["id", "n_words", "n_removed", "kept"])

    rows = _with_spans(docs, id_col, text_col, width)
    return rows.mapInArrow(
        strip, f"id {rows.schema['id'].dataType.simpleString()}, n_words long, n_removed long, kept string").withColumnRenamed("id", id_col)
