"""What a load brought in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyloom.functions.columns import col, flat_columns
from tallyloom.functions.stats import missing, percent

# Bytes one cell of a type takes; text is measured.
CELL_BYTES = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4, T.DoubleType: 8,
    T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8,
}


def column_bytes(df: DataFrame, name: str) -> Column:
    """Estimated bytes of a column: a fixed width per value present, or the length of its text."""
    width = next((w for t, w in CELL_BYTES.items() if isinstance(df.schema[name].dataType, t)), None)
    if width:
        return F.count(col(name)) * F.lit(width).cast("long")
    return F.coalesce(F.sum(F.octet_length(col(name).cast("string")).cast("long")), F.lit(0))


def table_bytes(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    parts = [column_bytes(df, c) for c in (columns or flat_columns(df))]
    total = F.lit(0).cast("long")
    for p in parts:
        total = total + p
    return total


def load_report(df: DataFrame) -> DataFrame:
    """One row: size, missing cells, duplicate rows and bytes.

    Grouping by all columns once serves every figure: duplicates are the rows beyond the first of
    each group, and sums over groups are weighted by their row count.
    """
    names = df.columns
    groups = df.groupBy(*[col(c) for c in names]).agg(F.count(F.lit(1)).alias("_rows"))
    weight = F.col("_rows")
    gaps = [F.coalesce(F.sum(F.when(col(c).isNull(), weight)), F.lit(0)).alias(f"m{i}") for i, c in enumerate(names)]
    sizes = []
    for c in names:
        width = next((w for t, w in CELL_BYTES.items() if isinstance(df.schema[c].dataType, t)), None)
        cell = F.lit(width).cast("long") if width else F.octet_length(col(c).cast("string")).cast("long")
        sizes.append(F.coalesce(F.sum(F.when(col(c).isNotNull(), cell * weight)), F.lit(0)))
    counted = groups.agg(
        F.coalesce(F.sum(weight), F.lit(0)).alias("rows"), F.count(F.lit(1)).alias("distinct_rows"), *gaps,
        sum(sizes[1:], sizes[0]).alias("bytes"),
    )
    gap = [F.col(f"m{i}") for i in range(len(names))]
    with_gap = sum([(g > 0).cast("long") for g in gap[1:]], (gap[0] > 0).cast("long"))
    cells = sum(gap[1:], gap[0])
    width = F.lit(len(names)).cast("long")
    return counted.select(
        "rows", width.alias("columns"), with_gap.alias("columns_with_missing"),
        percent(with_gap, width).alias("pct_columns_with_missing"), cells.alias("missing_cells"),
        percent(cells, F.col("rows") * width).alias("pct_missing_cells"),
        (F.col("rows") - F.col("distinct_rows")).alias("duplicate_rows"), "bytes", (F.col("rows") == 0).alias("is_empty"),
    )
