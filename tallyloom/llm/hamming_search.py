"""Exact top-k search of binary codes in Hamming distance, by incremental multi-index hashing.

A vector's code has one bit for each coordinate: whether it is above the coordinate's threshold. Codes are cut into m
segments. Two codes that differ in fewer than m * (r + 1) bits differ in at most r bits of some segment, so looking up
every segment with up to r flipped bits finds all codes within m * (r + 1) - 1. The radius grows until this covers the
distance of a query's (k + 1)th neighbour; then the query is done, since no other code can be nearer.

The index of a segment is dealt into blocks by the first bits of the segment, so a query visits the blocks whose first
bits differ from its own in at most r places; a block with many codes or many queries is dealt further, by hash. A task
looks up its queries in one block and returns at most k + 1 codes for each. Equal codes are one entry: only their k + 1
smallest ids can be among the results.
"""

from __future__ import annotations

import math
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.tables import checkpointed, columns_of, ordered

WORD = 64
#: Codes and queries that one task holds at a time, about.
CODES, QUERIES = 200_000, 20_000


def codes(vectors: DataFrame, bits: int, thresholds: list[float] | None = None) -> DataFrame:
    """(id, code) of (id, vector); NULL ids, NULL vectors and vectors of another length are left out, and a coordinate
    that is NULL or NaN gives the bit 0."""
    if not 0 < bits <= WORD:
        raise ValueError(f"codes have 1 to {WORD} bits, not {bits}")
    cuts = thresholds or [0.0] * bits
    rows = vectors.filter((F.size("vector") == bits) & F.col("id").isNotNull())
    code: Column = F.lit(0).cast("long")
    for i in range(bits):
        x = F.col("vector")[i]
        code = code.bitwiseOR(F.shiftleft(F.coalesce((x > cuts[i]) & ~F.isnan(x), F.lit(False)).cast("long"), i))
    return rows.select("id", code.alias("code"))


def _segments(bits: int, m: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment."""
    return [(bits * s // m, bits * (s + 1) // m - bits * s // m) for s in range(m)]


@cache
def _flips(width: int, many: int) -> np.ndarray:
    """All numbers of `width` bits with `many` ones."""
    return np.array([sum(1 << b for b in some) for some in combinations(range(width), many)], dtype=np.int64)


def _values(parts: list[tuple[int, int]], code: str) -> Column:
    """(segment, value) of every segment, to explode."""
    return F.array(*[
        F.struct(F.lit(s).alias("segment"), F.shiftrightunsigned(code, first).bitwiseAND(F.lit((1 << width) - 1)).alias("value"))
        for s, (first, width) in enumerate(parts)])


def _look_up(parts: list[tuple[int, int]], prefix: int, radius: int, k: int):
    """For one block: the best k + 1 codes of each query at exactly `radius` flipped bits of the segment."""

    def find(key: tuple, index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(index) and len(queries):
            index = index.sort_values("value", kind="stable")
            value, code = index["value"].to_numpy(), index["code"].to_numpy()
            smallest, ids = index["smallest"].to_numpy(), index["ids"].to_numpy()
            low = parts[int(key[0])][1] - prefix
            block = int(key[1])
            for query, own, limit in zip(queries["query"].to_numpy(), queries["value"].to_numpy(), queries["bound"].to_numpy()):
                flipped = int((int(own) >> low) ^ block).bit_count()
                if radius - flipped > low:
                    continue
                probes = (own & ((1 << low) - 1) | block << low) ^ _flips(low, radius - flipped)
                a, b = np.searchsorted(value, probes), np.searchsorted(value, probes, side="right")
                size = b - a
                if not size.any():
                    continue
                at = np.repeat(a - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                distance = np.bitwise_count((code[at] ^ query).view(np.uint64)).astype(np.int32)
                near = np.flatnonzero(distance <= limit)
                if len(near) > k + 1:
                    near = near[np.lexsort((smallest[at[near]], distance[near]))[: k + 1]]
                at = at[near]
                out.append((np.full(len(at), query), code[at], distance[near], smallest[at], ids[at]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 5
        return pd.DataFrame(dict(zip(("query", "code", "distance", "smallest", "ids"), cols)))

    return find


def _round(
    index: DataFrame, pending: DataFrame, parts: list[tuple[int, int]], prefix: int, radius: int, k: int, code_rows: int, query_rows: int,
) -> DataFrame:
    """Candidates of the pending (query, bound) at one radius."""
    widths = F.array(*[F.lit(w) for _, w in parts])
    asked = pending.select("query", "bound", F.explode(_values(parts, "query")).alias("x")).select("query", "bound", "x.*")
    near = [int(f) for j in range(min(radius, prefix) + 1) for f in _flips(prefix, j)]
    first = F.floor(F.col("value") / F.pow(F.lit(2), widths[F.col("segment")] - prefix)).cast("long")
    asked = asked.withColumn("block", F.explode(F.transform(F.array(*[F.lit(f).cast("long") for f in near]), lambda f: first.bitwiseXOR(f))))
    # how often each block is dealt: by its codes, and by its queries
    sizes = index.groupBy("segment", "block").agg(F.ceil(F.count("*") / code_rows).cast("int").alias("subs"))
    loads = asked.groupBy("segment", "block").agg(F.ceil(F.count("*") / query_rows).cast("int").alias("chunks"))
    dealt = checkpointed(sizes.join(loads, ["segment", "block"]))
    left = index.join(dealt, ["segment", "block"]).withColumn("sub", F.pmod(ordered("code"), F.col("subs")))
    left = left.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    right = asked.join(dealt, ["segment", "block"]).withColumn("chunk", F.pmod(ordered("query"), F.col("chunks")).cast("int"))
    right = right.withColumn("sub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("subs").cast("long") - 1)))
    keys = ["segment", "block", "sub", "chunk"]
    left = left.select(*keys, "value", "code", "smallest", "ids")
    right = right.select(*keys, "query", "value", "bound")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        _look_up(parts, prefix, radius, k), "query long, code long, distance int, smallest long, ids long")


def search(
    vectors: DataFrame, queries: DataFrame, k: int, bits: int, segments: int = 4, id_col: str = "vec_id",
    vector_col: str = "embedding", thresholds: list[float] | None = None, code_rows: int = CODES, query_rows: int = QUERIES,
) -> DataFrame:
    """(query id, rank, neighbour, distance): the k nearest other ids of each query, ties by the smaller id.

    Both frames have `id_col` (integers) and `vector_col`. An id that is repeated has the smallest of its codes; a query
    is never its own neighbour. Fewer than k other vectors give fewer rows. NULL ids, NULL
    vectors and vectors of another length are left out; empty tables give no rows.
    """
    parts = _segments(bits, segments)
    if not 2 <= segments <= bits:
        raise ValueError(f"{bits} bits can't be cut into {segments} segments")
    coded, wanted = (
        checkpointed(codes(columns_of(x, id=id_col, vector=vector_col), bits, thresholds).groupBy("id").agg(F.min("code").alias("code")))
        for x in (vectors, queries))
    place = F.row_number().over(Window.partitionBy("code").orderBy("id"))
    held = checkpointed(coded.withColumn("place", place).filter(F.col("place") <= k + 1).select("id", "code"))
    entries = held.groupBy("code").agg(F.min("id").alias("smallest"), F.count("*").alias("ids"))
    total = entries.count()
    prefix = min(max(0, math.ceil(math.log2(max(1, total) / code_rows))), min(w for _, w in parts))
    index = entries.select("code", "smallest", "ids", F.explode(_values(parts, "code")).alias("x")).select("code", "smallest", "ids", "x.*")
    width = F.array(*[F.lit(w) for _, w in parts])[F.col("segment")]
    index = checkpointed(index.withColumn("block", F.floor(F.col("value") / F.pow(F.lit(2), width - prefix)).cast("long")))

    asked = wanted.select(F.col("code").alias("query")).distinct()
    pending = checkpointed(asked.withColumn("bound", F.lit(bits)))
    found = None
    for radius in range(bits):
        new = _round(index, pending, parts, prefix, radius, k, code_rows, query_rows)
        merged = (found.unionByName(new) if found is not None else new).distinct()
        best = Window.partitionBy("query").orderBy("distance", "smallest")
        merged = merged.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k + 1)
        found = checkpointed(merged.drop("place"))
        covered = segments * (radius + 1) - 1
        # a query goes on while fewer than k + 1 ids (one may be its own) lie within what is covered
        state = found.groupBy("query").agg(
            F.sum(F.when(F.col("distance") <= covered, F.col("ids")).otherwise(0)).alias("sure"),
            F.when(F.count("*") > k, F.max("distance")).otherwise(bits).alias("bound"))
        pending = checkpointed(asked.join(state, "query", "left").filter(F.coalesce("sure", F.lit(0)) <= k).select(
            "query", F.coalesce("bound", F.lit(bits)).alias("bound")))
        if covered >= bits or pending.isEmpty():
            break
    ids = found.select("query", "code", "distance").join(held, "code")
    pairs = wanted.select(F.col("id").alias("own"), F.col("code").alias("query")).join(ids, "query").filter("own <> id")
    rank = F.row_number().over(Window.partitionBy("own").orderBy("distance", "id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        F.col("own").alias(id_col), "rank", F.col("id").alias("neighbor_id"), "distance")
