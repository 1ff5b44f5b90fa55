"""Class rebalancing: synthetic oversampling, edited nearest neighbours, and both."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.columns import col, number, require, stable_hash
from tallyloom.functions.selection import select_ranks
from tallyloom.operators.neighbors import CELL_POINTS, attach_neighbours, nearest_rows, numbered, others, point
from tallyloom.operators.split import class_sizes, per_class
from tallyloom.session import checkpointed

COPIES_PER_ROW = 1000
NEIGHBOURS = 5


def _uniform(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(2**31)) / F.lit(float(2**31))


def smote(df: DataFrame, label: str, features: Sequence[str], key: str, k: int = NEIGHBOURS, seed: int = 42,
          cell_points: int = CELL_POINTS) -> DataFrame:
    """Grow every class to the size of the largest by points between a row and one of its neighbours.

    Returns (key, label, features…, synthetic, copy): the given rows, and the new ones under the key
    of the row they start from.  Rows of a class give equal numbers of copies, up to one.  A key of any type tells rows apart.
    """
    require(df, label, key, *features)
    rows = df.select(col(key), col(label), *[number(f).alias(f) for f in features])
    sizes = class_sizes(df, label)
    largest = max(sizes.values())
    short = {cls: largest - n for cls, n in sizes.items() if n < largest}
    for cls in short:
        if sizes[cls] <= k:
            raise ValueError(f"class {cls[0]!r} has {sizes[cls]} rows; more than {k} are needed")
    given = rows.withColumns({"synthetic": F.lit(False), "copy": F.lit(0).cast("long")})
    if not short:
        return given
    wanted_class = col(label).isin([cls for (cls,) in short])
    base = rows.filter(wanted_class)
    place = stable_hash([key], seed)
    extra = {cls: need % sizes[cls] for cls, need in short.items()}
    ranks = select_ranks(base.select(col(label), place.alias("_h")), "_h", [label],
                         lambda cls, n: [extra[cls] - 1] if extra[cls] else [],
                         sorted({extra[c] / sizes[c] for c in short}))
    cut = per_class(df, label, {cls: at[extra[cls] - 1] for cls, (_, at) in ranks.items() if extra[cls]}, "bigint")
    whole = per_class(df, label, {cls: need // sizes[cls] for cls, need in short.items()}, "bigint")
    copies = whole + F.coalesce((place <= cut).cast("long"), F.lit(0))

    base, own = numbered(base, key)
    found = nearest_rows(base, base, features, own, point(features), k, group=label, cell_points=cell_points)
    near = attach_neighbours(base, found, features, label).withColumn("_near", others("neighbours", own, k)).drop("neighbours")
    # a rare class may need very many copies of a row: runs of copies are spread over tasks first
    runs = near.withColumn("_copies", copies).filter("_copies > 0").withColumn(
        "_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / COPIES_PER_ROW))))
    if max(need // sizes[cls] for cls, need in short.items()) > COPIES_PER_ROW:
        runs = runs.repartition(col(key), F.col("_run"))
    last = F.least(F.col("_copies"), (F.col("_run") + 1) * COPIES_PER_ROW)
    each = runs.withColumn("copy", F.explode(F.sequence(F.col("_run") * COPIES_PER_ROW + 1, last)))
    other = F.get(F.col("_near"), F.pmod(F.xxhash64(col(key), F.col("copy"), F.lit(f"{seed}:row")), F.size("_near")).cast("int"))
    each = each.withColumns({"_other": other["payload"], "_gap": _uniform(col(key), F.col("copy"), F.lit(f"{seed}:gap"))})
    new = each.select(
        col(key), col(label),
        *[(col(f) + F.col("_gap") * (F.col("_other")[i] - col(f))).alias(f) for i, f in enumerate(features)],
        F.lit(True).alias("synthetic"), "copy")
    return given.unionByName(new)


def _mode(labels: Column) -> Column:
    """Most frequent element of a short array, the smallest of equals."""
    ranked = F.transform(F.array_distinct(labels), lambda v: F.struct(
        (-F.size(F.filter(labels, lambda x: x == v))).alias("count"), v.alias("value")))
    return F.array_min(ranked)["value"]


def edited_nearest_neighbours(df: DataFrame, label: str, features: Sequence[str], key: str, k: int = NEIGHBOURS,
                              cell_points: int = CELL_POINTS) -> DataFrame:
    """Drop rows of the largest class whose label is not the most frequent one among their k neighbours.

    `key` identifies a row.
    """
    require(df, label, key, *features)
    names = df.columns
    df, key = numbered(df, key)
    sizes = class_sizes(df, label)
    (majority,) = min(sizes, key=lambda cls: (-sizes[cls], cls[0]))
    suspects = df.filter(col(label) == F.lit(majority))
    found = nearest_rows(suspects, df, features, key, col(label), k, cell_points=cell_points)
    marked = attach_neighbours(suspects, found, features).withColumn("_near", others("neighbours", key, k))
    kept = marked.filter(_mode(F.transform("_near", lambda x: x["payload"])) == col(label)).drop("neighbours", "_near")
    return df.filter(~col(label).eqNullSafe(F.lit(majority))).unionByName(kept).select(*[col(c) for c in names])


def smote_enn(df: DataFrame, label: str, features: Sequence[str], key: str, k: int = NEIGHBOURS, seed: int = 42,
              cell_points: int = CELL_POINTS) -> DataFrame:
    """Oversample, then clean the largest class of the result.

    New rows have no key of their own: the rank of key and copy number is one.
    """
    grown = checkpointed(smote(df, label, features, key, k, seed, cell_points))
    keyed = grown.withColumn("_id", F.concat_ws(":", col(key).cast("string"), F.col("copy").cast("string")))
    return edited_nearest_neighbours(keyed, label, features, "_id", k, cell_points).drop("_id")


SAMPLERS = {"SMOTE": smote, "SMOTE-ENN": smote_enn}


def choose_sampler(name: str | None):
    """The sampler of a name; None and "null" mean no resampling."""
    if name is None or str(name).lower() == "null":
        return None
    try:
        return SAMPLERS[str(name).upper()]
    except KeyError:
        raise ValueError(f"unknown resampling method {name!r}; use one of {sorted(SAMPLERS)} or null") from None
