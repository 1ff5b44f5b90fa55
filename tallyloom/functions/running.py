"""Running totals over a whole column without putting the column into one task.

The input holds one row per (group, value), so ties are collapsed before any
shuffle.  Boundaries from a quantile sketch cut the value range into as many buckets as
keep each at about `BUCKET_ROWS` rows; each bucket is summed on its own and the few bucket totals are
carried over.  A group that holds most of the rows is spread over all buckets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window, functions as F, types as T

from tallyloom.functions.columns import col
from tallyloom.functions.selection import TooManyGroups, exact_quantiles
from tallyloom.session import checkpointed

#: Rows of a bucket, and the most buckets there are.
BUCKET_ROWS, MAX_BUCKETS = 50_000, 65_536


def bucket_count(rows: int) -> int:
    """Buckets of about BUCKET_ROWS rows; beyond MAX_BUCKETS of them (3·10⁹ distinct values) they grow."""
    return min(max(1, math.ceil(rows / BUCKET_ROWS)), MAX_BUCKETS)


def with_bucket(df: DataFrame, value: str, sums: Sequence[str], buckets: int) -> DataFrame:
    """Add `_bucket`, a number that grows with the value.

    The boundary query also reads the sums, so that its plan equals the plan of
    the main branch and Spark reuses the shuffle instead of scanning twice.  A row
    looks for its boundary among every root-th one and then between two of those.
    """
    if buckets == 1:
        return df.withColumn("_bucket", F.lit(0))
    probs = [i / buckets for i in range(1, buckets)]
    edges = df.agg(
        F.struct(
            F.array_distinct(F.percentile_approx(col(value), probs, 20 * buckets)).alias("at"),
            *[F.sum(col(s)).alias(f"t{i}") for i, s in enumerate(sums)],
        ).alias("edges")
    )
    root = max(1, math.isqrt(buckets))
    every = F.filter(F.col("edges.at"), lambda e, i: i % root == root - 1)
    edges = edges.select(F.struct(F.col("edges.at").alias("at"), every.alias("every")).alias("edges")).scalar()
    below = F.size(F.filter(F.col("_edges")["every"], lambda e: e < col(value))) * root
    within = F.size(F.filter(F.slice(F.col("_edges")["at"], below + 1, F.lit(root)), lambda e: e < col(value)))
    return df.withColumn("_edges", edges).withColumn("_bucket", F.coalesce(below + within, F.lit(0))).drop("_edges")


def running_totals(df: DataFrame, value: str, sums: Sequence[str], by: Sequence[str] = (), descending: bool = False,
                   following: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Add `cum_<s>`, the inclusive running total in value order, for every s in `sums`.

    Each name in `following` also yields `next_<name>`, the value on the next row.
    `df` must have one row per (by, value); it is written once, and its length decides on the buckets.
    """
    if buckets is None:
        df = checkpointed(df)
        buckets = bucket_count(df.count())
    keys = [col(b) for b in by] or [F.lit(1)]
    order = [col(value).desc() if descending else col(value).asc()]
    ahead = F.col("_bucket").desc() if descending else F.col("_bucket").asc()
    cut = with_bucket(df, value, sums, buckets)

    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    so_far = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = cut.withColumns({f"cum_{s}": F.sum(col(s)).over(so_far) for s in sums})
    if following:
        local = local.withColumn("_next", F.lead(F.struct(*[col(f) for f in following])).over(inside))

    first_row = F.max_by if descending else F.min_by
    totals = cut.groupBy(*[col(b) for b in by], "_bucket").agg(
        *[F.sum(col(s)).alias(f"_sum_{s}") for s in sums],
        *([first_row(F.struct(*[col(f) for f in following]), col(value)).alias("_head")] if following else []),
    )
    across = Window.partitionBy(*keys).orderBy(ahead)
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *[col(b).alias(f"_by_{b}") for b in by],
        F.col("_bucket").alias("_at"),
        *[F.coalesce(F.sum(f"_sum_{s}").over(before), F.lit(0)).alias(f"_before_{s}") for s in sums],
        *([F.lead("_head").over(across).alias("_next_head")] if following else []),
    )
    match = F.col("_bucket") == F.col("_at")
    for b in by:
        match = match & col(b).eqNullSafe(col(f"_by_{b}"))
    joined = local.join(carried, match)
    out = joined.withColumns({f"cum_{s}": F.col(f"cum_{s}") + F.col(f"_before_{s}") for s in sums})
    if following:
        ahead_row = F.coalesce("_next", "_next_head")
        out = out.withColumns({f"next_{f}": ahead_row[f] for f in following})
    return out.select(*[col(c) for c in df.columns], *[f"cum_{s}" for s in sums], *[f"next_{f}" for f in following])


def average_ranks(df: DataFrame, value: str) -> DataFrame:
    """One row per distinct value with its count and the average rank of its rows."""
    counted = df.filter(col(value).isNotNull()).groupBy(col(value)).agg(F.count(F.lit(1)).alias("n"))
    return running_totals(counted, value, ["n"]).select(
        col(value), "n", (F.col("cum_n") - (F.col("n") - 1) / F.lit(2.0)).alias("avg_rank")
    )


def quantiles_by(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """(by…, n, q): exact interpolated quantiles per group as an array, plus the group's row count.

    Few groups are narrowed down in a couple of scans that shuffle no rows; their result is a small
    table.  Many groups go through running totals over value counts, which stay in Spark.
    """
    try:
        found = exact_quantiles(df, [value], probs, by=by, with_counts=True)
    except TooManyGroups:
        return grouped_quantiles(df, value, probs, by)
    schema = T.StructType([df.schema[b] for b in by] + [
        T.StructField("n", T.LongType()), T.StructField("q", T.ArrayType(T.DoubleType()))])
    rows = [(*key[:-1], n, q) for key, (n, q) in found.items()]
    return df.sparkSession.createDataFrame(rows, schema)


def grouped_quantiles(df: DataFrame, value: str, probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """`quantiles_by` for any number of groups.

    Works on value counts, so neither a large group nor a repeated value meets in one task.
    """
    counted = (
        df.filter(col(value).isNotNull())
        .groupBy(*[col(b) for b in by], col(value).cast("double").alias("_v"))
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    run = running_totals(counted, "_v", ["_c"], by=by)
    sizes = counted.groupBy(*[col(b) for b in by]).agg(F.sum("_c").alias("n"))
    sizes = sizes.select(*[col(b).alias(f"_g_{b}") for b in by], "n")
    match = reduce(and_, [col(b).eqNullSafe(col(f"_g_{b}")) for b in by])
    placed = run.join(sizes, match)

    def at_rank(rank):
        here = (F.col("cum__c") - F.col("_c") <= rank) & (rank < F.col("cum__c"))
        return F.max(F.when(here, F.col("_v")))

    picks = []
    for i, p in enumerate(probs):
        position = F.lit(float(p)) * (F.col("n") - 1)
        picks.append(at_rank(F.floor(position)).alias(f"_lo{i}"))
        picks.append(at_rank(F.ceil(position)).alias(f"_hi{i}"))
    picked = placed.groupBy(*[col(b) for b in by], "n").agg(*picks)
    values = []
    for i, p in enumerate(probs):
        position = F.lit(float(p)) * (F.col("n") - 1)
        share = position - F.floor(position)
        values.append(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * share)
    return picked.select(*[col(b) for b in by], "n", F.array(*values).alias("q"))
