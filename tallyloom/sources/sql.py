"""SQL sources: a query over named frames, and a partitioned read from a database."""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tallyloom.functions.columns import nan_to_null


def query_text(query_or_path: str) -> str:
    """The query itself, or the content of the existing .sql file it names."""
    if query_or_path.lower().endswith(".sql") and Path(query_or_path).exists():
        return Path(query_or_path).read_text(encoding="utf-8")
    return query_or_path


def run_sql(spark: SparkSession, query_or_path: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Run a query with `{name}` placeholders standing for the given frames; no view is registered."""
    return nan_to_null(spark.sql(query_text(query_or_path), **tables))


def load_database(spark: SparkSession, url: str, query_or_path: str, key: str, lower: int, upper: int,
                  partitions: int, properties: Mapping[str, str] | None = None) -> DataFrame:
    """Read a query result over JDBC in `partitions` ranges of an integer key, one task each.

    The bounds only shape the ranges: rows outside of them land in the first or last task.
    """
    source = f"({query_text(query_or_path).strip().rstrip(';')}) AS source"
    return nan_to_null(
        spark.read.jdbc(
            url, source, column=key, lowerBound=lower, upperBound=upper, numPartitions=partitions,
            properties=dict(properties or {}),
        )
    )
