"""Exact deduplication by a tree merge of sorted digest runs.

Each input partition is a run. The texts become digests; a run is reduced to one entry for each digest. Runs then meet in
binomial rounds: in the round that looks at bits k to k+b of the run number, the runs that differ only in those bits are
merged (2**b ways at once). They are exchanged by ranges of the digest, each task sorts the parts of the runs it got, and
one ordered pass joins entries of one digest that agree on the second hash and the length as well, adds their counts, and
keeps the entry with the longest original text, then the smallest identifier. After the last round a digest has one entry;
one that has two belongs to different texts, which `disagreements` counts. No round puts a whole run into one task, and
equal digests of a run are one entry before they are sent.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.tables import checkpointed, columns_of, whole

SPACES = r"[\x20\x09-\x0D]+"
BITS = 4
_KEY = ["digest", "check", "size"]


def normalised(text: Column) -> Column:
    """The text without space, tab, line feed, vertical tab, form feed and carriage return."""
    return F.regexp_replace(text, SPACES, "")


def digest_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, run, digest, check, size, points): one row for each document; points counts the original's code points."""
    rows = columns_of(docs, id=id_col, text=text_col).select("id", whole("text").alias("text"))
    rows = rows.select("id", F.char_length("text").alias("points"), normalised(F.col("text")).alias("bare"))
    return rows.select(
        "id", F.spark_partition_id().alias("run"), F.unhex(F.sha2("bare", 256)).alias("digest"),
        F.xxhash64("bare").alias("check"), F.octet_length("bare").alias("size"), "points",
    )


def _reduced(entries: DataFrame) -> DataFrame:
    """One entry for each run and digest: the longest original, then the smallest id; an id of NULL comes last."""
    return entries.groupBy("run", *_KEY).agg(F.min("best").alias("best"), F.sum("members").alias("members"))


def _merged(entries: DataFrame, bits: int) -> DataFrame:
    """The runs that differ in their last bits, merged: ranges of sorted entries, reduced in one ordered pass."""
    entries = entries.withColumn("run", F.shiftright("run", bits))
    # The grouping finds its rows dealt by range and in order, so it neither shuffles nor sorts them again.
    return _reduced(entries.repartitionByRange("run", "digest").sortWithinPartitions("run", *_KEY))


def merge_runs(rows: DataFrame, bits: int = BITS) -> DataFrame:
    """(digest, check, size, keep, members) over all runs, by rounds of 2**bits-way merges."""
    last = rows.agg(F.max("run")).first()[0] or 0
    best = F.struct((-F.col("points")).alias("shorter"), F.col("id").isNull().alias("unnamed"), F.col("id").alias("id"))
    merged = _reduced(rows.select("run", *_KEY, best.alias("best"), F.lit(1).cast("long").alias("members")))
    while last:
        merged = _merged(checkpointed(merged), bits)
        last >>= bits
    return merged.select(*_KEY, F.col("best.id").alias("keep"), "members")


def disagreements(merged: DataFrame) -> int:
    """How many digests stand for texts that differ in the second hash or the length: they are kept apart."""
    return merged.groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").count()


def duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """Which document stays for each document: (id, keep_id, group_size, kept, text_sha256).

    A NULL text is an empty one; all empty texts are equal. An id of NULL stays only if its whole group has none. Rows
    that repeat an id within a group are all marked as kept if that id stays (`deduplicated` leaves one of them). An
    empty table gives no rows; further columns are ignored.
    """
    rows = checkpointed(digest_rows(docs, id_col, text_col))
    winners = merge_runs(rows, bits)
    return rows.drop("run").join(winners, _KEY).select(
        F.col("id").alias(id_col), F.col("keep").alias("keep_id"), F.col("members").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """The documents with one row of each group of equal texts, in their own columns."""
    kept = duplicates(docs, id_col, text_col, bits).filter("kept")
    own = _unused(docs.columns)
    id_, digest, copies = own("id"), own("digest"), own("copies")
    kept = kept.select(F.col(id_col).alias(id_), F.unhex("text_sha256").alias(digest)).groupBy(id_, digest).agg(F.count("*").alias(copies))
    text = own("text")
    tagged = docs.withColumn(text, F.unhex(F.sha2(normalised(whole(f"`{text_col}`")), 256)))
    same = tagged[id_col].eqNullSafe(kept[id_]) & (tagged[text] == kept[digest])
    found = tagged.join(kept, same)
    # Only rows that repeat an id within their group are compared once more.
    out = found.filter(F.col(copies) == 1).select(*docs.columns, text).unionByName(
        found.filter(F.col(copies) > 1).select(*docs.columns, text).dropDuplicates([id_col, text]))
    return out.drop(text)


def _unused(names: list[str]) -> Callable[[str], str]:
    """Makes column names that the frame does not have."""
    taken = {n.lower() for n in names}

    def make(name: str) -> str:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        return name

    return make
