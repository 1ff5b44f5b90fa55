"""Cleaning chains and fitted transforms on Structured Streaming.

They are projections and filters, so the same function serves a batch and a stream.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tallyloom.session import scratch_path


def to_stream(df: DataFrame) -> DataFrame:
    """A file stream over the rows of a frame, by way of the shared folder."""
    spark = df.sparkSession
    path = scratch_path(spark, "stream-in")
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def write_stream(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Append a transformed stream to Parquet, exactly once through its checkpoint."""
    return (
        stream.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    )


def drain(df: DataFrame, transform: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Send the rows of a frame through a transform as a stream and read the result back."""
    spark = df.sparkSession
    stream = transform(to_stream(df))
    path = scratch_path(spark, "stream-out")
    started = write_stream(stream, path, scratch_path(spark, "stream-state"))
    started.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
