"""Near-duplicate groups: fast similarity sketches, banding, and links confirmed on the full shingle sets.

Sketch. A set is hashed into t bins, round after round with a fresh hash function, until every bin holds a value; a bin
keeps the smallest value of the first round that reached it. After t rounds, the bins still empty take the smallest
value of a hash function of their own. So every coordinate fills, large sets need one round, and the coordinates in
which two sets agree concentrate around their Jaccard similarity.

Links. Equal sets are one node. Bands of the sketch put nodes into buckets, and
1. in each bucket the smallest node is confirmed against all others; that resolves most buckets;
2. in buckets whose nodes are not all connected by then, the other pairs are confirmed as well: pair by pair in small
   buckets; in large ones, the nodes of overlapping buckets are dealt into blocks of bounded size and a task finds the
   missing links between two blocks, without writing pairs.
Pairs already connected are skipped, since they can't change a component. Nothing is capped; step 2 costs the square of
the number of blocks of a group that stays unconnected.

With 36 bands of 7, a pair at the threshold 0.85 shares no band once in a million times; at 0.8, 36 bands of 5 do the same.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.components import components
from tallyloom.llm.shingles import mixed, seeds, shingle_sets
from tallyloom.llm.tables import byte_blocks, checkpointed, columns_of, ordered, whole

WIDTH, BANDS, ROWS, PERCENT = 5, 36, 7, 85
#: Buckets of up to so many nodes are compared pair by pair.
SMALL = 32
#: Shingles in a block of a large bucket.
BLOCK = 500_000
_BATCH = 128

_LOW, _HIGH = (np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9FB21C651E98DF25))


def sketch(shingles: np.ndarray, t: int, salts: np.ndarray) -> np.ndarray:
    """The t coordinates of a set that is not empty, t up to 256; `salts` are 2t numbers."""
    n = len(shingles)
    out = np.zeros(t, dtype=np.uint64)
    filled = np.zeros(t, dtype=bool)
    step = max(1, min(t, math.ceil(1.4 * t * math.log(t) / n))) if t > 1 else 1
    low = np.uint64((1 << 48) - 1)
    for at in range(0, t, step):
        own = salts[at : min(t, at + step)]
        value = mixed(shingles[None, :] ^ own[:, None])
        place = (value >> np.uint64(32)) * np.uint64(t) >> np.uint64(32)
        turn = np.arange(at, at + len(own), dtype=np.uint64)[:, None]
        keys = np.sort((place << np.uint64(56) | turn << np.uint64(48) | value & low).ravel())
        bins = keys >> np.uint64(56)
        first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
        where = bins[first].astype(np.int64)
        new = ~filled[where]
        out[where[new]] = keys[first[new]]
        filled[where] = True
        if filled.all():
            return out
    rest = np.flatnonzero(~filled)
    out[rest] = mixed(shingles[None, :] ^ salts[t + rest][:, None]).min(axis=1)
    return out


def band_keys(shingles: np.ndarray, bands: int, rows: int, salts: np.ndarray) -> np.ndarray:
    own = sketch(shingles, bands * rows, salts).reshape(bands, rows)
    factors = seeds(rows, 41) | np.uint64(1)
    return mixed((mixed(own) * factors).sum(axis=1, dtype=np.uint64) + seeds(bands, 43))


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch (id, text) in blocks of bounded bytes: hashing takes many times the memory of the texts."""
    for a, b in byte_blocks(pc.binary_length(batch.column(1)).to_pylist(), _BATCH):
        yield batch.slice(a, b - a)


def shingle_rows(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """(id, n, low, high, bands) of (id, text): the size of the set, two sums that name it, its band keys."""
    salts = seeds(2 * bands * rows, 47)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _blocks(batch):
                sets = shingle_sets(part.column(1).cast(pa.binary()).to_pylist(), width)
                low = np.array([mixed(x + _LOW).sum(dtype=np.uint64) for x in sets], dtype=np.uint64)
                high = np.array([np.bitwise_xor.reduce(mixed(x ^ _HIGH)) if len(x) else 0 for x in sets], dtype=np.uint64)
                keys = [band_keys(x, bands, rows, salts).view(np.int64) if len(x) else None for x in sets]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array(low.view(np.int64)),
                    pa.array(high.view(np.int64)), pa.array(keys, pa.list_(pa.int64())),
                ], ["id", "n", "low", "high", "bands"])

    return docs.mapInArrow(make, "id long, n long, low long, high long, bands array<long>")


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """(node, n, items) of (id, text): the shingles, sorted, 8 bytes each."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _blocks(batch):
                sets = shingle_sets(part.column(1).cast(pa.binary()).to_pylist(), width)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(x) for x in sets], pa.int64()),
                    pa.array([x.tobytes() for x in sets], pa.binary()),
                ], ["node", "n", "items"])

    return docs.mapInArrow(make, "node long, n long, items binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(z.as_buffer(), dtype=np.uint64) for z in (x, y))
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both = int((y[at] == x).sum())
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    one = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("items").alias("xa"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("items").alias("xb"))
    fits = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    both = pairs.join(two, "b").join(one, "a").filter(fits).select("a", "b", "xa", "xb")
    return both.mapInArrow(compare, "a long, b long")


def missing_links(items: list[np.ndarray], labels: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join different labels among some sets, as few as connect what is connected.

    Sets of `side` 0 and 1 are compared with each other; with one side only, all are. An inverted index counts the
    common items of one set with all others; the sets of the most frequent label are only looked up.
    """
    sizes = np.array([len(x) for x in items], dtype=np.int64)
    flat = np.concatenate(items)
    owner = np.repeat(np.arange(len(items)), sizes)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    _, codes, counts = np.unique(labels, return_inverse=True, return_counts=True)
    root = list(range(len(counts)))

    def top(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    alone = side.min() == side.max()
    links = []
    for s in np.flatnonzero(codes != counts.argmax()).tolist():
        a, b = np.searchsorted(flat, items[s]), np.searchsorted(flat, items[s], side="right")
        lengths = b - a
        at = np.repeat(a - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        common = np.bincount(owner[at], minlength=len(items))
        near = 100 * common >= percent * (sizes + sizes[s] - common)
        if not alone:
            near &= side != side[s]
        for other in np.flatnonzero(near).tolist():
            x, y = top(codes[s]), top(codes[other])
            if x != y:
                root[x] = y
                links.append((s, other))
    return links


def block_links(members: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """The missing links within each cluster of (cluster, node, label, n), a pair of blocks of about `block` shingles at a time."""
    sizes = members.groupBy("cluster").agg(F.ceil(F.sum("n") / F.lit(block)).cast("int").alias("blocks"))
    dealt = members.join(sizes, "cluster").withColumn("own", F.pmod(ordered("node"), F.col("blocks")).cast("int"))
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    copies = dealt.select("cluster", "node", "label", "own", F.explode(others).alias("other")).select(
        "cluster", "node", "label", (F.col("own") > F.col("other")).cast("int").alias("side"),
        F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
    )

    def find(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        items = [np.frombuffer(x, dtype=np.uint64) for x in rows["items"]]
        labels, nodes = rows["label"].to_numpy(), rows["node"].to_numpy()
        if len(rows) < 2 or labels.min() == labels.max():
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        found = missing_links(items, labels, rows["side"].to_numpy(), percent)
        return pd.DataFrame({"a": [nodes[x] for x, _ in found], "b": [nodes[y] for _, y in found]}, dtype="int64")

    return copies.join(sets.select("node", "items"), "node").groupBy("cluster", "i", "j").applyInPandas(find, "a long, b long")


def _labelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    named = labels.select("node", F.col("component").alias("label"))
    return members.join(named, "node", "left").withColumn("label", F.coalesce("label", "node"))


def node_links(nodes: DataFrame, docs: DataFrame, width: int, percent: int, small: int = SMALL, block: int = BLOCK) -> DataFrame:
    """Confirmed links (a, b) between nodes (node, n, bands); `docs` are (id, text)."""
    banded = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("node").alias("pivot"), F.count("*").alias("size")).filter("size > 1")
    members = checkpointed(banded.join(shared, "bucket"))
    involved = members.select(F.col("node").alias("id")).distinct()
    sets = checkpointed(full_sets(docs.join(involved, "id", "left_semi"), width))

    stars = members.filter("node <> pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    links = checkpointed(confirmed(stars, sets, percent))

    named = _labelled(members, components(links))
    mixed_buckets = named.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y")
    open_members = checkpointed(named.join(mixed_buckets.select("bucket"), "bucket"))

    few = open_members.filter(F.col("size") <= small).filter("node <> pivot")
    one = few.select("bucket", F.col("node").alias("a"), F.col("n").alias("na"), F.col("label").alias("la"))
    two = few.select("bucket", F.col("node").alias("b"), F.col("n").alias("nb"), F.col("label").alias("lb"))
    fits = (F.col("a") < F.col("b")) & (F.col("la") != F.col("lb")) & (
        100 * F.least("na", "nb") >= percent * F.greatest("na", "nb"))
    pairs = one.join(two, "bucket").filter(fits).select("a", "b").distinct()
    links = links.unionByName(checkpointed(confirmed(pairs, sets, percent)))

    many = checkpointed(open_members.filter(F.col("size") > small).select("pivot", "node", "label", "n").distinct())
    if many.isEmpty():
        return links
    clusters = components(many.select(F.col("pivot").alias("a"), F.col("node").alias("b")))
    clustered = many.select("node", "label", "n").distinct().join(clusters.withColumnRenamed("component", "cluster"), "node")
    return links.unionByName(checkpointed(block_links(clustered, sets, percent, block)))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT,
    bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """The group of each document: (id, n_shingles, component_id, kept).

    Documents are linked when 100 * intersection >= percent * union of their sets of `width` words; component_id is the
    smallest id that links reach. A text that is NULL, empty or without words has no shingles and no links. Rows that
    share an id are one document, and each of them is returned. A row without an id (NULL) is linked with nothing: its
    component_id is NULL and it is kept. An empty table gives no rows; further columns are ignored. Ids are integers.
    """
    texts = columns_of(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), whole("text").alias("text"))
    found = checkpointed(shingle_rows(texts, width, bands, rows))
    usable = found.filter("n > 0 AND id IS NOT NULL")
    nodes = checkpointed(
        usable.groupBy("n", "low", "high").agg(F.min(F.struct("id", "bands")).alias("x"))
        .select("n", "low", "high", F.col("x.id").alias("node"), F.col("x.bands").alias("bands"))
    )
    links = node_links(nodes.select("node", "n", "bands"), texts, width, percent)

    own = found.select("id", "n", "low", "high").join(nodes.select("n", "low", "high", "node"), ["n", "low", "high"], "left")
    own = own.select("id", "n", F.when(F.col("id").isNotNull(), F.coalesce("node", "id")).alias("node"))
    own = checkpointed(own)
    twice = own.filter("id IS NOT NULL").groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("z")).filter("a <> z")
    same = own.join(twice.select("id", "a"), "id").select("a", F.col("node").alias("b"))
    groups = components(links.unionByName(same))
    return own.join(groups, "node", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("component_id"),
        F.coalesce("component", "node").eqNullSafe(F.col("id")).alias("kept"),
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The documents with one of each group, the smallest id, in their own columns; rows that share an id all stay."""
    gone = near_duplicates(docs, id_col, text_col, **settings).filter(~F.col("kept"))
    gone = gone.select(F.col(id_col).alias("_tl_id")).distinct()
    return docs.join(gone, docs[id_col] == gone["_tl_id"], "left_anti")
