"""Train/test split and fold assignment.

Rows are ordered by a hash of their key.  The place where a split falls in that order is an exact
order statistic of the hash, so assigning a row is a comparison with a literal: no sort, no window
and no shuffle of the rows, however large a class is.  Of more classes than the driver holds, sizes, quotas
and cuts are tables, which the rows are joined with.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.columns import HASH_SPAN, col, require, stable_hash
from tallyloom.functions.dictionary import ranked
from tallyloom.functions.running import running_totals
from tallyloom.functions.selection import select_ranks
from tallyloom.session import checkpointed

SPLIT = "split"
#: Classes whose sizes and cuts the driver holds.
MAX_CLASSES = 10_000


def _largest_remainder(sizes: Mapping[tuple, int], total: int) -> dict[tuple, int]:
    """Whole-number quotas in proportion to the sizes; the largest fractions are rounded up."""
    whole = sum(sizes.values())
    exact = {k: total * n / whole for k, n in sizes.items()}
    quota = {k: math.floor(x) for k, x in exact.items()}
    short = total - sum(quota.values())
    for k in sorted(exact, key=lambda k: (quota[k] - exact[k], str(k)))[:short]:
        quota[k] += 1
    return quota


def _many(df: DataFrame, label: str) -> bool:
    """Whether there are more classes than the driver holds."""
    return df.select(col(label)).distinct().limit(MAX_CLASSES + 1).count() > MAX_CLASSES


def _size_table(hashed: DataFrame, label: str) -> DataFrame:
    return hashed.groupBy(col(label).alias("_class")).agg(F.count(F.lit(1)).alias("_n"))


def _quota_table(sizes: DataFrame, total: int, whole: int) -> DataFrame:
    """(_class, _n, _quota) by largest remainder: the classes are ranked by their fraction, then by their text."""
    exact = F.lit(float(total)) * F.col("_n") / F.lit(float(whole))
    sizes = sizes.withColumn("_floor", F.floor(exact)).withColumns({
        "_rest": F.col("_floor") - exact, "_text": F.coalesce(F.col("_class").cast("string"), F.lit("None"))})
    placed = checkpointed(ranked(sizes, ["_rest", "_text"], "_rank"))
    short = total - (placed.agg(F.sum("_floor")).first()[0] or 0)
    return placed.select("_class", "_n", (F.col("_floor") + (F.col("_rank") < short).cast("long")).alias("_quota"))


def _class_cuts(hashed: DataFrame, label: str, ends: DataFrame) -> DataFrame:
    """(_class, _cuts): the hashes at the ranks `_ends` of each class, from running counts in buckets of hashes."""
    counted = hashed.groupBy(col(label).alias("_own"), "_h").agg(F.count(F.lit(1)).alias("_c"))
    run = running_totals(counted, "_h", ["_c"], by=["_own"])
    placed = run.join(ends, F.col("_own").eqNullSafe(F.col("_class")))
    here = F.exists("_ends", lambda e: (F.col("cum__c") - F.col("_c") <= e) & (e < F.col("cum__c")))
    return placed.filter(here).groupBy("_class").agg(F.sort_array(F.collect_list("_h")).alias("_cuts"))


def _joined(df: DataFrame, label: str, cuts: DataFrame) -> DataFrame:
    return df.join(cuts, col(label).eqNullSafe(F.col("_class")), "left").drop("_class")


def class_sizes(df: DataFrame, label: str) -> dict[tuple, int]:
    rows = df.groupBy(col(label)).agg(F.count(F.lit(1)).alias("n")).limit(MAX_CLASSES + 1).collect()
    if len(rows) > MAX_CLASSES:
        raise ValueError(f"{label!r} has more than {MAX_CLASSES} values; it is not a class label")
    return {(r[0],): r["n"] for r in rows}


def per_class(df: DataFrame, label: str, values: Mapping[tuple, object], kind: str) -> Column:
    """A literal of type `kind` per class, looked up by the label of the row; NULL for a class without one."""
    key_type = df.schema[label].dataType
    known = {cls: v for (cls,), v in values.items() if cls is not None}
    out = F.lit(None).cast(kind)
    if known:
        pairs = [x for cls, v in known.items() for x in (F.lit(cls).cast(key_type), F.lit(v).cast(kind))]
        out = F.try_element_at(F.create_map(*pairs), col(label))
    if (None,) in values:
        out = F.when(col(label).isNull(), F.lit(values[(None,)]).cast(kind)).otherwise(out)
    return out


def with_split(df: DataFrame, keys: Sequence[str], test_size: float = 0.2, stratify: str | None = None,
               seed: int = 42) -> DataFrame:
    """Add `split` = test for ceil(test_size·n) rows, else train; `keys` must identify a row.

    With `stratify` every class gives its share, by largest remainder.
    """
    if not 0 < test_size < 1:
        raise ValueError("test_size must lie between 0 and 1")
    require(df, *keys, *([stratify] if stratify else []))
    place = stable_hash(keys, seed)
    hashed = df.select(*([col(stratify)] if stratify else []), place.alias("_h"))
    by = [stratify] if stratify else []
    if stratify and _many(df, stratify):
        sizes = _size_table(hashed, stratify)
        whole = sizes.agg(F.sum("_n")).first()[0]
        quotas = _quota_table(sizes, math.ceil(test_size * whole), whole)
        ends = quotas.filter("_quota > 0").select("_class", F.array(F.col("_quota") - 1).alias("_ends"))
        marked = _joined(df, stratify, _class_cuts(hashed, stratify, ends))
        return marked.withColumn(SPLIT, F.when(place <= F.col("_cuts")[0], "test").otherwise("train")).drop("_cuts")
    if stratify:
        sizes = class_sizes(df, stratify)
        quota = _largest_remainder(sizes, math.ceil(test_size * sum(sizes.values())))
        found = select_ranks(hashed, "_h", by, lambda k, n: [quota[k] - 1] if quota[k] else [], [test_size])
        cut = per_class(df, stratify, {k: at[quota[k] - 1] for k, (_, at) in found.items() if quota[k]}, "bigint")
    else:
        found = select_ranks(hashed, "_h", by, lambda _, n: [math.ceil(test_size * n) - 1], [test_size])
        cut = F.lit(next(iter(found[()][1].values())) if found else None)
    return df.withColumn(SPLIT, F.when(place <= cut.cast("bigint"), "test").otherwise("train"))


def split_dataset(df: DataFrame, target: str, keys: Sequence[str], test_size: float = 0.2, stratify: bool = False,
                  random_state: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test); the target stays in the row, so nothing has to be glued back."""
    require(df, target)
    marked = with_split(df, keys, test_size, target if stratify else None, random_state)
    return tuple(marked.filter(col(SPLIT) == part).drop(SPLIT) for part in ("train", "test"))


def stack_splits(train: DataFrame, test: DataFrame) -> DataFrame:
    """One frame with a split column, columns matched by name."""
    return train.withColumn(SPLIT, F.lit("train")).unionByName(test.withColumn(SPLIT, F.lit("test")))


def join_target(features: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Features and target held in two tables, joined on the row key."""
    return features.join(target, list(keys))


def _fold_ends(n: int, folds: int) -> list[int]:
    """Zero-based rank of the last row of every fold but the last; sizes differ by one at most."""
    sizes = [n // folds + (1 if i < n % folds else 0) for i in range(folds)]
    return [sum(sizes[: i + 1]) - 1 for i in range(folds - 1)]


def with_folds(df: DataFrame, keys: Sequence[str], folds: int = 5, stratify: str | None = None, seed: int = 42,
               name: str = "fold") -> DataFrame:
    """Add a fold number 0…folds−1; fold sizes differ by one row at most, per class with `stratify`."""
    if folds < 2:
        raise ValueError("at least two folds are needed")
    require(df, *keys, *([stratify] if stratify else []))
    by = [stratify] if stratify else []
    place = stable_hash(keys, seed)
    hashed = df.select(*[col(b) for b in by], place.alias("_h"))
    number = reduce(lambda a, b: a + b, [
        F.coalesce((place > F.get(F.col("_cuts"), F.lit(i))).cast("int"), F.lit(0)) for i in range(folds - 1)])
    if stratify and _many(df, stratify):
        # Folds of a class smaller than `folds` end at the same row, before which there is none: no cut.
        base, extra = F.floor(F.col("_n") / folds), F.col("_n") % folds
        last = F.transform(F.sequence(F.lit(1), F.lit(folds - 1)), lambda i: i * base + F.least(i.cast("long"), extra) - 1)
        ends = _size_table(hashed, stratify).select("_class", F.array_distinct(F.filter(last, lambda e: e >= 0)).alias("_ends"))
        return _joined(df, stratify, _class_cuts(hashed, stratify, ends)).withColumn(name, number).drop("_cuts")
    near = [(i + 1) / folds for i in range(folds - 1)]
    found = select_ranks(hashed, "_h", by, lambda _, n: _fold_ends(n, folds), near)

    ends = {k: [at[e] for e in _fold_ends(n, folds)] for k, (n, at) in found.items()}
    if stratify:
        cuts = per_class(df, stratify, ends, "array<bigint>")
    else:
        cuts = F.lit(ends[()]).cast("array<bigint>") if ends else F.lit(None).cast("array<bigint>")
    return df.withColumn("_cuts", cuts).withColumn(name, number).drop("_cuts")


def by_hash_share(df: DataFrame, keys: Sequence[str], test_size: float, seed: int = 42) -> DataFrame:
    """A split without any job: the share is met in expectation, not exactly."""
    edge = int(test_size * HASH_SPAN)
    return df.withColumn(SPLIT, F.when(stable_hash(keys, seed) < edge, "test").otherwise("train"))
