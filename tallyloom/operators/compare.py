"""What changed between two tables: rows, columns and size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.columns import rows_from_aggregate
from tallyloom.functions.naming import bare_name
from tallyloom.functions.stats import percent
from tallyloom.sources.report import table_bytes


def column_changes(before: list[str], after: list[str]) -> tuple[list[str], list[str], list[tuple[str, str]]]:
    """(dropped, added, renamed): a dropped and an added name with the same letters and digits are a rename."""
    dropped, added = sorted(set(before) - set(after)), sorted(set(after) - set(before))
    renamed = []
    for new in list(added):
        old = next((b for b in dropped if bare_name(b) == bare_name(new)), None)
        if old is not None:
            renamed.append((old, new))
            dropped.remove(old)
            added.remove(new)
    return dropped, added, renamed


def _measure(metric: str, before: Column, after: Column, detail: str = "") -> Column:
    return F.struct(
        F.lit(metric).alias("metric"), before.cast("long").alias("before"), after.cast("long").alias("after"),
        F.lit(detail).alias("detail"),
    )


def compare_dataframes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(metric, before, after, change, pct, detail): one aggregate per table, columns from the schemas."""
    dropped, added, renamed = column_changes(before.columns, after.columns)
    old = before.agg(F.struct(F.count(F.lit(1)).alias("rows"), table_bytes(before).alias("bytes")).alias("b"))
    new = after.agg(F.count(F.lit(1)).alias("rows"), table_bytes(after).alias("bytes"))
    both = new.withColumn("_b", old.scalar())
    names = {
        "columns_dropped": ", ".join(dropped), "columns_added": ", ".join(added),
        "columns_renamed": ", ".join(f"{a} -> {b}" for a, b in renamed),
    }
    counts = {"columns_dropped": len(dropped), "columns_added": len(added), "columns_renamed": len(renamed)}
    cells = {
        "rows": _measure("rows", F.col("_b.rows"), F.col("rows")),
        "columns": _measure("columns", F.lit(len(before.columns)), F.lit(len(after.columns))),
        **{k: _measure(k, F.lit(0), F.lit(n), names[k]) for k, n in counts.items()},
        "bytes": _measure("bytes", F.col("_b.bytes"), F.col("bytes")),
    }
    wide = both.select(*[c.alias(k) for k, c in cells.items()])
    change = F.col("after") - F.col("before")
    return rows_from_aggregate(wide, list(cells)).select(
        "metric", "before", "after", change.alias("change"), percent(F.abs(change), F.col("before")).alias("pct"), "detail",
    )
