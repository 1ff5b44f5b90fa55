"""Operators that keep state on a stream: duplicates within a delay, and a profile of event-time windows.

Their state is bounded by the delay: what is older than the latest event time seen, less the delay, is let go, and rows
that come in later than that are dropped. State lies in the query's checkpoint folder, so a lost executor or a restart
goes on from the last finished batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.columns import col, number, numeric_columns, require
from tallyloom.session import scratch_path
from tallyloom.streaming.replay import write_stream


def drop_repeats(stream: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """The first row that arrives of each key, and none of those that follow it within `delay` of event time.

    A key is forgotten once the watermark is past its first row's time plus `delay`; a row of that key is then new. NULLs
    are equal as keys. A row without a time is never late, and is kept like any other.
    """
    require(stream, time, *keys)
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def windowed_profile(df: DataFrame, time: str, width: str, columns: Sequence[str] | None = None, delay: str | None = None,
                     slide: str | None = None) -> DataFrame:
    """(window_start, window_end, column, rows, missing, mean) for each event-time window and column.

    The same rows come from a frame and from a stream over it, for windows the watermark has passed and rows that were not
    late. Windows start at multiples of `slide` (by default `width`) since 1970; a row without a time is in none. The mean
    is that of a numeric column's values, NULL for other columns and for windows without values. A window is one row of
    the grouping, so a busy window is reduced by every task before it is sent.
    """
    columns = list(columns if columns is not None else [c for c in df.columns if c != time])
    require(df, time, *columns)
    numbers = set(numeric_columns(df))
    if df.isStreaming:
        if delay is None:
            raise ValueError("a stream needs a delay after which rows are late")
        df = df.withWatermark(time, delay)
    window = F.window(col(time), width, slide) if slide else F.window(col(time), width)
    wide = df.groupBy(window.alias("_window")).agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(col(c).isNull()).alias(f"_m{i}") for i, c in enumerate(columns)],
        *[F.avg(number(c)).alias(f"_a{i}") for i, c in enumerate(columns) if c in numbers])
    cells = [F.struct(
        F.lit(c).alias("column"), F.col(f"_m{i}").alias("missing"),
        (F.col(f"_a{i}") if c in numbers else F.lit(None).cast("double")).alias("mean")) for i, c in enumerate(columns)]
    return wide.select("_window", "_rows", F.inline(F.array(*cells))).select(
        F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), "column", F.col("_rows").alias("rows"),
        "missing", "mean")


def replay(parts: Sequence[DataFrame], transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Send frames through a stream one after the other, as one run of the job each, and read the whole output back.

    The runs share a checkpoint, so state and watermark live on between them.
    """
    spark = parts[0].sparkSession
    path, out, state = (scratch_path(spark, label) for label in ("stream-in", "stream-out", "stream-state"))
    schema = None
    for part in parts:
        part.write.mode("append").parquet(path)
        stream = transform(spark.readStream.schema(part.schema).parquet(path))
        schema = stream.schema
        write_stream(stream, out, state).awaitTermination()
    return spark.read.schema(schema).parquet(out)


def heartbeat(df: DataFrame, time: str, by: str) -> DataFrame:
    """One row `by` after the latest time, its other columns NULL: what a silent source sends to close open windows.

    The row moves the watermark, and the window that it falls into stays open.
    """
    latest = df.agg(F.max(col(time)).alias("t"))
    kind = df.schema[time].dataType.simpleString()
    return latest.select(*[
        (F.col("t") + F.expr(f"INTERVAL {by}")).cast(kind).alias(time) if f.name == time else F.lit(None).cast(f.dataType).alias(f.name)
        for f in df.schema.fields])
