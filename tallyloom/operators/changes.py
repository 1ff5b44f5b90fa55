"""Which rows and cells differ between two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tallyloom.functions.columns import col, require

#: Parts that the differing rows of one key are ranked in.
PARTS = 64


def _comparable(name: str, kind: T.DataType) -> Column:
    """Maps can't be grouped, and -0.0 is 0.0."""
    if isinstance(kind, T.MapType):
        return F.to_json(col(name))
    return col(name) + F.lit(0).cast(kind) if isinstance(kind, (T.FloatType, T.DoubleType)) else col(name)


def row_changes(before: DataFrame, after: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(columns…, before, after): every distinct row whose number of copies differs, with both numbers.

    One shuffle of the rows, equal ones of a task reduced to a count first; whole rows are compared, not hashes.
    """
    columns = list(columns if columns is not None else [c for c in before.columns if c in after.columns])
    require(before, *columns)
    require(after, *columns)

    def side(df: DataFrame, place: int) -> DataFrame:
        cells = [_comparable(c, df.schema[c].dataType).alias(f"_c{i}") for i, c in enumerate(columns)]
        return df.select(*cells, F.lit(1 - place).cast("long").alias("_before"), F.lit(place).cast("long").alias("_after"))

    both = side(before, 0).union(side(after, 1))
    counts = both.groupBy(*[f"_c{i}" for i in range(len(columns))]).agg(F.sum("_before").alias("_before"), F.sum("_after").alias("_after"))
    counts = counts.filter("_before <> _after")
    return counts.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)], F.col("_before").alias("before"), F.col("_after").alias("after"))


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    return reduce(and_, [left[n].eqNullSafe(right[n]) for n in names])


def table_changes(before: DataFrame, after: DataFrame, key: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """(key…, change, pair, column, before, after): the cells that differ between rows of one key.

    Rows that both tables have equally often are no change. Of each key, the other rows of both tables, every copy by itself,
    are put in the order of their cells and paired: a pair is `changed` and gives a row for each cell that differs, with both
    values as text. What one table has more of is `added` or `removed` and gives one row without a column. NULL keys are equal
    and NULL cells too. `pair` counts from 1 within a key. `columns` are those compared, by default all that both tables have.

    Whole rows are shuffled once; only rows that differ are ranked. A key with very many of them is ranked in `PARTS` parts by
    a hash of the row, whose sizes are carried over, so it is not held by one task.
    """
    key = list(key)
    require(before, *key)
    require(after, *key)
    columns = [c for c in (columns if columns is not None else before.columns) if c in after.columns and c not in key]
    differing = row_changes(before, after, [*key, *columns])
    ks, cs = [f"_k{i}" for i in range(len(key))], [f"_c{i}" for i in range(len(columns))]
    more = F.col("after") - F.col("before")
    rows = differing.select(
        *[col(k).alias(n) for k, n in zip(key, ks)], *[col(c).alias(n) for c, n in zip(columns, cs)],
        F.when(more > 0, 1).otherwise(0).alias("_side"), F.abs(more).alias("_copies"))
    order = F.xxhash64(F.lit(0), *cs)
    rows = rows.withColumn("_order", order).withColumn("_part", F.shiftright("_order", 64 - (PARTS.bit_length() - 1)))

    # The place of a row among its key's: rows of earlier parts, then those before it in its own part.
    group = [*ks, "_side"]
    parts = rows.groupBy(*group, "_part").agg(F.sum("_copies").alias("_size"))
    ahead = F.sum("_size").over(Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(*group, "_part", F.coalesce(ahead, F.lit(0)).alias("_ahead"))
    within = Window.partitionBy(*group, "_part").orderBy("_order", *cs).rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("_own", F.coalesce(F.sum("_copies").over(within), F.lit(0)))
    ranked = ranked.join(parts, _same(ranked, parts, [*group, "_part"])).select(
        *[ranked[c] for c in [*group, *cs]],
        F.explode(F.sequence(F.lit(1).cast("long"), ranked["_copies"])).alias("_copy"), parts["_ahead"], ranked["_own"])
    ranked = ranked.withColumn("_pair", F.col("_ahead") + F.col("_own") + F.col("_copy"))

    cells = F.struct(*cs, F.lit(True).alias("_there"))
    pairs = ranked.groupBy(*ks, "_pair").agg(
        F.first(F.when(F.col("_side") == 0, cells), ignorenulls=True).alias("_b"),
        F.first(F.when(F.col("_side") == 1, cells), ignorenulls=True).alias("_a"))

    def text(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}").cast("string")

    both = F.col("_b").isNotNull() & F.col("_a").isNotNull()
    none = F.lit(None).cast("string")
    shape = "array<struct<change:string,column:string,before:string,after:string>>"
    changed = F.filter(
        F.array(*[F.struct(F.lit("changed").alias("change"), F.lit(c).alias("column"), text("_b", n).alias("before"), text("_a", n).alias("after"),
                           F.col(f"_b.{n}").eqNullSafe(F.col(f"_a.{n}")).alias("same")) for c, n in zip(columns, cs)]),
        lambda x: ~x["same"]) if columns else F.array()
    changed = F.transform(changed, lambda x: F.struct(x["change"], x["column"], x["before"], x["after"])) if columns else changed
    alone = F.array(F.struct(
        F.when(F.col("_b").isNull(), "added").otherwise("removed").alias("change"), none.alias("column"), none.alias("before"), none.alias("after")))
    out = pairs.select(*ks, "_pair", F.inline(F.when(both, changed.cast(shape)).otherwise(alone.cast(shape))))
    return out.select(
        *[F.col(n).alias(k) for k, n in zip(key, ks)], "change", F.col("_pair").alias("pair"), "column", "before", "after")
