"""Phrase collocations by counts of shards: shards count all their phrases, and one of them sends the text of a frequent one.

Texts are dealt to shards that fit a task, of about one size. Each shard counts the phrases it holds and sends their hashes
and counts, in order of the hash and packed by ranges of hashes; the shards' counts of a range are summed, and the phrases
that reach `support` are kept. No shard leaves out what is rare in it, so what is sent grows with the text and not with the
number of shards.

This is done for words, for pairs, and for longer phrases, so that each round need only look at phrases whose parts were
frequent in the one before. What a pass must know of earlier ones is a bit table of `BITS` bits, whatever the size of the
data; its false hits are counted like others and fall below the support.

The sum of a frequent phrase chooses one of the shards that hold it, and a last pass sends the phrase's text from there, so
that texts of phrases grow with their number and not with the shards that hold them. Two bit tables tell a shard what it was
chosen for; of known phrases with known parts, it sends what both hold by chance as well. Where that pass finds texts dealt to
other shards than before, a shard may not hold what it was chosen for; phrases that are left without a text are then sent by
all shards that hold them.

Phrases are told apart by 64-bit hashes, which differ between languages.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm import wordstream
from tallyloom.llm.shingles import mixed, seeds
from tallyloom.llm.tables import columns_of, stored, whole

#: Bytes of text in a shard, from half to one and a half times as many; a task mines one shard at a time.
SHARD = 40 << 20
#: Bits of a table of phrases (16 MB), and of the number of one of its parts. A row carries phrases of one part.
BITS, PARTS = 27, 10
#: Lengths of the phrases that are mined in one round.
ROUNDS = ((1,), (2,), (3, 4))

_BREAKS = np.zeros(256, dtype=bool)
_BREAKS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_GAPS = _BREAKS.copy()
_GAPS[[9, 32]] = True
_GAP = re.compile(rb"[ \t.,;:!?\n-\r]")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_FACTOR = seeds(1, 53)[0] | np.uint64(1)
#: Hashes that are worked on at a time, so that intermediate arrays stay small beside a shard's own.
_SLICE = 1 << 19
#: Bits of the classes, of adjoining hashes, in which the phrases of a shard are sorted and counted, one after the other.
_CLASS = 3


class _Shard:
    """The words of some texts of one language: hashes that other languages don't share, places, and whether a word follows the one before it in a piece.

    The texts end in line feeds. `places` keeps where words begin, and the texts, which only the phrases' texts need.
    """

    def __init__(self, lang: str, text: bytes | bytearray, places: bool = True):
        salt = np.uint64(hash_text(lang))
        # Room for all words there can be; only what is written takes memory.
        most = len(text) // 2 + 1
        words, joined = np.empty(most, dtype=np.uint64), np.empty(most, dtype=bool)
        starts = np.empty(most if places else 0, dtype=np.int64 if len(text) >> 31 else np.int32)
        n, at, last, breaks = 0, 0, -1, 0
        while at < len(text):
            gap = _GAP.search(text, at + wordstream.BLOCK)
            stop = gap.start() if gap else len(text)
            block = bytes(text[at:stop]).translate(_LOWER)
            start, _, own = wordstream.words(block, _GAPS)
            broken = np.cumsum(_BREAKS[np.frombuffer(block, dtype=np.uint8)], dtype=np.int32)
            if len(own):
                piece = broken[start].astype(np.int64) + breaks
                joined[n : n + len(own)] = np.diff(piece, prepend=last) == 0
                last = int(piece[-1])
                words[n : n + len(own)] = own ^ salt
                if places:
                    starts[n : n + len(own)] = start + at
                n += len(own)
            breaks += int(broken[-1])
            at = stop
        self.words, self.joined, self.start = words[:n], joined[:n], starts[:n]
        self.text = text if places else b""

    def grams(self, size: int, at: int, end: int) -> np.ndarray:
        """Hashes of the phrases of `size` words that begin at the words from `at` to `end`."""
        out = self.words[at:end]
        for k in range(1, size):
            out = mixed(out * _FACTOR + self.words[at + k : end + k])
        return out

    def slices(self, size: int) -> Iterator[tuple[int, int]]:
        """The places of phrases of `size` words, a slice at a time."""
        n = max(0, len(self.words) - size + 1)
        for at in range(0, n, _SLICE):
            yield at, min(n, at + _SLICE)

    def phrase(self, first: int, size: int) -> str:
        last = int(self.start[first + size - 1])
        gap = _GAP.search(self.text, last)
        own = bytes(self.text[self.start[first] : gap.start() if gap else len(self.text)])
        return b" ".join(own.translate(_LOWER).split()).decode()


def hash_text(text: str) -> int:
    """A number for a language's name."""
    start, end, own = wordstream.words(b"x" + text.encode().hex().encode())
    return int(own[0])


def _both(shorter: np.ndarray, size: int, joined: np.ndarray) -> np.ndarray:
    """Where phrases of `size` words begin whose two parts of one word less are marked."""
    if size == 1:
        return shorter
    marked = shorter[:-1] & shorter[1:]
    return marked & joined[1:] if size == 2 else marked


def _counted(shard: _Shard, size: int, marks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(distinct hashes in order, their counts) of the marked phrases, class by class."""
    for c in range(1 << _CLASS):
        parts = [np.empty(0, np.uint64)]
        for at, end in shard.slices(size):
            own = shard.grams(size, at, end)
            parts.append(own[marks[at:end] & (own >> np.uint64(64 - _CLASS) == c)])
        keys = np.concatenate(parts)
        parts.clear()
        keys.sort()
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
        yield keys[first], np.diff(np.append(first, len(keys)))


def _keep(shard: _Shard, size: int, marks: np.ndarray, test: Callable[[np.ndarray], np.ndarray]) -> None:
    """Unmarks the phrases that fail a test."""
    for at, end in shard.slices(size):
        own = marks[at:end]
        own[own] = test(shard.grams(size, at, end)[own])


def _start_of_round(shard: _Shard, sizes: tuple[int, ...], known: np.ndarray | None) -> np.ndarray:
    """Marks of the phrases of one word less than the round's first size that are known."""
    size = sizes[0] - 1
    marks = np.ones(max(0, len(shard.words) - max(size, 1) + 1), dtype=bool)
    for k in range(1, size):
        marks &= shard.joined[k : k + len(marks)]
    if size:
        _keep(shard, size, marks, lambda own: _held(known, own))
    return marks


def _held(table: np.ndarray | None, keys: np.ndarray) -> np.ndarray:
    if table is None:
        return np.ones(len(keys), dtype=bool)
    at = keys >> np.uint64(64 - BITS)
    return (table[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, bytearray]]:
    """(language, texts) of each shard and language. A task's texts are cut into shards of `size` bytes, and what is left
    of them goes with the last one unless it is half as much."""
    full: dict[str, bytearray] = {}
    rest: dict[str, bytearray] = {}
    held = more = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = text.as_buffer()
            into = full if held < size else rest
            buffer = into.setdefault(lang, bytearray())
            buffer += own
            buffer += b"\n"
            if into is full:
                held += len(own) + 1
            else:
                more += len(own) + 1
            if more >= size // 2:
                for lang in list(full):
                    yield lang, full.pop(lang)
                full, rest, held, more = rest, {}, more, 0
    for lang, buffer in rest.items():
        full.setdefault(lang, bytearray()).extend(buffer)
    rest.clear()
    for lang in list(full):
        yield lang, full.pop(lang)


def _numbered(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, str, bytearray]]:
    """The shards with their numbers, which are the same in each pass that deals texts to tasks in the same way."""
    task = TaskContext.get().partitionId() << 32
    for i, (lang, text) in enumerate(_shards(batches, size)):
        yield task | i, lang, text


def local_support(support: int, shards: int) -> int:
    """The least count in one of so many shards that a phrase of `support` must reach in one of them at least; no query
    cuts by it."""
    return (support - 1) // shards + 1


def _mine(shard_bytes: int, sizes: tuple[int, ...], known: Broadcast | None) -> Callable:
    """(part, shard, hashes, counts) of all phrases in a shard whose parts are known."""
    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = known.value if known is not None else None
        for number, lang, text in _numbered(batches, shard_bytes):
            shard = _Shard(lang, text, places=False)
            del text
            marks = _start_of_round(shard, sizes, table)
            for size in sizes:
                marks = _both(marks, size, shard.joined)
                for own in _counted(shard, size, marks):
                    yield _packed(number, *own)

    return mine


def _packed(shard: int, hashes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    """A row for each part, of hashes in order: 7 bytes of each, as the part has the rest, and 4 of each count."""
    part = (hashes >> np.uint64(64 - PARTS)).astype(np.int32)
    cuts = np.append(np.flatnonzero(np.diff(part, prepend=np.int32(-1))), len(part)).tolist()
    low = np.ascontiguousarray(hashes.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7])
    most = np.minimum(counts, (1 << 32) - 1).astype("<u4")
    rows = [(int(part[a]), shard, low[a:b].tobytes(), most[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]
    kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 4, kinds)], ["part", "shard", "hashes", "counts"])


def _choices(hashes: np.ndarray, shards: np.ndarray | np.uint64, seed: int) -> np.ndarray:
    """Numbers of phrases in certain shards, in the part of the phrase; another number for each seed."""
    low = np.uint64((1 << 64 - PARTS) - 1)
    return hashes & ~low | mixed((hashes + np.uint64(seed)) * _FACTOR + shards) & low


def _bits(keys: np.ndarray) -> bytes:
    """The bits of the table that stand for keys of one part."""
    bits = np.zeros(1 << BITS - PARTS, dtype=np.uint8)
    bits[(keys >> np.uint64(64 - BITS)).astype(np.int64) & (1 << BITS - PARTS) - 1] = 1
    return np.packbits(bits, bitorder="little").tobytes()


#: Columns of table bits: phrases that are known, and twice those that a shard was chosen for.
_TABLES = ("known", "chosen", "again")
_SUMS = "part int, known binary, chosen binary, again binary, key long, count long"


def _summed(support: int) -> Callable[[pa.Table], pa.Table]:
    """Rows `_SUMS` of a part: (key, count) of the phrases whose counts add up to the support, and one row of table bits for them and for
    one shard of each."""
    def summed(rows: pa.Table) -> pa.Table:
        part = rows["part"][0].as_py()
        low, counts = (np.frombuffer(b"".join(rows[c].to_pylist()), dtype=k) for c, k in (("hashes", "u1"), ("counts", "<u4")))
        held = np.array([len(c) // 4 for c in rows["counts"].to_pylist()])
        shards = rows["shard"].to_numpy().astype(np.uint64)
        hashes = np.zeros((len(counts), 8), dtype=np.uint8)
        hashes[:, :7] = low.reshape(-1, 7)
        top = np.uint64(part << 64 - PARTS)
        hashes = hashes.reshape(-1).view("<u8").astype(np.uint64) | top
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        sums = np.add.reduceat(counts[order], first, dtype=np.int64)
        often = sums >= support
        keys, sums = hashes[first][often], sums[often]
        # One of the places of each phrase, as its hash has it, so that shards are chosen about equally often.
        several = np.diff(np.append(first, len(hashes)))[often].astype(np.uint64)
        place = order[first[often] + (mixed(keys) % several).astype(np.int64)]
        one = shards[np.searchsorted(np.cumsum(held), place, side="right")]
        n = len(keys)
        more = 1 if n else 0
        return pa.table({
            "part": pa.array([part] * (n + more), pa.int32()),
            "known": pa.array([None] * n + [_bits(keys)] * more, pa.binary()),
            "chosen": pa.array([None] * n + [_bits(_choices(keys, one, 0))] * more, pa.binary()),
            "again": pa.array([None] * n + [_bits(_choices(keys, one, 1))] * more, pa.binary()),
            "key": pa.array(keys.view(np.int64).tolist() + [None] * more, pa.int64()),
            "count": pa.array(sums.tolist() + [None] * more, pa.int64()),
        })

    return summed


def _without_text(rows: pa.Table) -> pa.Table:
    """(part, known) of the phrases of a part."""
    part = rows["part"][0].as_py()
    return pa.table({"part": pa.array([part], pa.int32()), "known": pa.array([_bits(rows["key"].to_numpy().view(np.uint64))], pa.binary())})


def _name(shard_bytes: int, sizes: tuple[int, ...], known: Broadcast, chosen: tuple[Broadcast, ...], missing: Broadcast | None = None) -> Callable:
    """Last pass: (lang, size, key, phrase, count) of the known phrases that a shard was chosen for, or that are missing; size 0 counts the words."""
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, choices = known.value, [choice.value for choice in chosen]
        wanted = missing.value if missing is not None else None
        for number, lang, text in _numbered(batches, shard_bytes):
            shard = _Shard(lang, text)
            yield _phrases(lang, 0, np.zeros(1, np.uint64), [""], [len(shard.words)])
            marks = _start_of_round(shard, sizes, None)
            for size in sizes:
                # The parts of a frequent phrase are frequent: few false hits are left for longer ones.
                marks = _both(marks, size, shard.joined)
                _keep(shard, size, marks, lambda own: _held(table, own))
                keys, places = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
                for at, end in shard.slices(size):
                    place = np.flatnonzero(marks[at:end])
                    own = shard.grams(size, at, end)[place]
                    mine = _held(wanted, own)
                    for seed, choice in enumerate(choices):
                        mine[mine] = _held(choice, _choices(own[mine], np.uint64(number), seed))
                    keys.append(own[mine])
                    places.append(place[mine] + at)
                distinct, first = np.unique(np.concatenate(keys), return_index=True)
                first = np.concatenate(places)[first]
                for at in range(0, len(distinct), 20_000):
                    part = slice(at, at + 20_000)
                    yield _phrases(lang, size, distinct[part], [shard.phrase(i, size) for i in first[part].tolist()], [None] * len(first[part]))

    return name


def _phrases(lang: str, size: int, keys: np.ndarray, texts: list[str], counts: list[int | None]) -> pa.RecordBatch:
    n = len(texts)
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * n, pa.string()), pa.array([size] * n, pa.int8()), pa.array(keys.view(np.int64)), pa.array(texts, pa.string()),
         pa.array(counts, pa.int64())], ["lang", "size", "key", "phrase", "count"])


def frequent_phrases(
    docs: DataFrame, support: int = 30, lang_col: str = "lang", text_col: str = "text", shard_bytes: int = SHARD,
) -> DataFrame:
    """(lang, size, phrase, count): all phrases of 1 to 4 words that stand `support` times or more in a language.

    The row of size 0 counts all words of a language. A NULL language is `und`.
    """
    texts = columns_of(docs, lang=lang_col, text=text_col).select(F.coalesce("lang", F.lit("und")).alias("lang"), whole("text").alias("text"))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # The scan's partitions are joined until one fills a shard; larger ones hold several.
    shards = max(1, -(-total // shard_bytes))
    texts = texts.coalesce(shards)
    context = docs.sparkSession.sparkContext
    tables = {name: np.zeros(1 << BITS - 3, dtype=np.uint8) for name in _TABLES}
    found, known = [], None
    for round_ in ROUNDS:
        sent = texts.mapInArrow(_mine(shard_bytes, round_, known), "part int, shard long, hashes binary, counts binary")
        found.append(stored(sent.groupBy("part").applyInArrow(_summed(support), _SUMS), "frequent"))
        _fill(tables, found[-1].filter("key is null"))
        known = context.broadcast(tables["known"].copy())
    sizes = tuple(size for round_ in ROUNDS for size in round_)
    named_as = "lang string, size tinyint, key long, phrase string, count long"
    chosen = tuple(context.broadcast(tables[name]) for name in _TABLES[1:])
    named = stored(texts.mapInArrow(_name(shard_bytes, sizes, known, chosen), named_as), "named")
    sums = found[0]
    for frame in found[1:]:
        sums = sums.unionByName(frame)
    sums = sums.filter("key is not null").select("part", "key", "count")

    def with_texts(sums: DataFrame, named: DataFrame) -> DataFrame:
        return stored(sums.join(named.filter("size > 0").drop("count").dropDuplicates(["key"]), "key", "left"), "phrases")

    out = with_texts(sums, named)
    rest = out.filter("phrase is null").select("part", "key", "count")
    if not rest.isEmpty():
        missing = {"known": np.zeros(1 << BITS - 3, dtype=np.uint8)}
        _fill(missing, rest.groupBy("part").applyInArrow(_without_text, "part int, known binary"))
        again = texts.mapInArrow(_name(shard_bytes, sizes, known, (), context.broadcast(missing["known"])), named_as)
        out = out.filter("phrase is not null").unionByName(with_texts(rest, again))
    words = named.filter("size = 0").groupBy("lang", "size", "phrase").agg(F.sum("count").alias("count"))
    return stored(out.select("lang", "size", "phrase", "count").unionByName(words), "phrases")


def _fill(tables: dict[str, np.ndarray], rows: DataFrame) -> None:
    """Sets the bits of rows (part, and the tables' names) in whole tables."""
    step = 1 << BITS - PARTS - 3
    for row in rows.select("part", *tables).collect():
        for name, table in tables.items():
            table[row["part"] * step : (row["part"] + 1) * step] |= np.frombuffer(row[name], dtype=np.uint8)


def collocations(
    docs: DataFrame, support: int = 30, covered: int = 80, top: int = 2000, lang_col: str = "lang", text_col: str = "text",
    shard_bytes: int = SHARD,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's phrases of 2 to 4 words that hold together best.

    A-Z are lower-cased; texts are split at `.,;:!?` and 0x0A-0x0D into pieces, and those at spaces and tabs into words. a
    is how often a phrase stands in pieces, n how many words the language has. A phrase is cut where the score
    floor(2000000 a / (l + r)) is least, at the first of several places; l and r are the counts of the two parts. A phrase
    within a longer one that has `covered` per cent of its count is left out. Equal scores go to the larger count, then to
    the lesser phrase in UTF-8. NULL texts are empty; a language without frequent phrases has no rows, and so has an
    empty table.
    """
    counts = frequent_phrases(docs, support, lang_col, text_col, shard_bytes)
    words = counts.filter("size = 0").select("lang", F.col("count").alias("n"))
    known = counts.filter("size > 0").select("lang", "phrase", "count")
    phrases = counts.filter("size > 1").select("lang", "phrase", F.col("size").cast("int").alias("size"), F.col("count").alias("a"))
    phrases = phrases.withColumn("words", F.split("phrase", " "))

    def part(start, length):
        return F.array_join(F.slice("words", start, length), " ")

    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    for side, own in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(side), F.col("count").alias(own)), ["lang", side])
    score = F.expr("cast(a as decimal(28,0)) * 2000000 div (cast(l as decimal(28,0)) + r)").alias("score")
    scored = cuts.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score, "k", "l", "r")).alias("s"))

    longer = phrases.filter("size > 2").select("lang", "a", "size", "words", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("length"))
    longer = longer.withColumn("start", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)))
    longer = longer.groupBy("lang", part(F.col("start"), F.col("length")).alias("phrase")).agg(F.max("a").alias("within"))
    left = scored.join(longer, ["lang", "phrase"], "left").filter(
        F.col("within").isNull() | (F.col("within").cast("decimal(28,0)") * 100 < F.col("a").cast("decimal(28,0)") * covered))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.select("lang", "phrase", "a", "s.l", "s.r", "s.score").withColumn("rank", F.row_number().over(order).cast("long"))
    return ranked.filter(F.col("rank") <= top).join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
