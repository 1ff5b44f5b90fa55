"""Sinks: models with their size, the metrics summary and feature importances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.functions.columns import col


def size_kb(spark: SparkSession, path: str) -> float:
    """Size of everything below a path in kilobytes, on any Hadoop file system."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return round(fs.getContentSummary(hadoop_path).getLength() / 1024, 2)


def save_model(spark: SparkSession, model, path: str) -> float:
    """Write a fitted Spark ML model, replacing an older one, and return its size in kilobytes."""
    model.write().overwrite().save(path)
    return size_kb(spark, path)


def side_by_side(test: Column, train: Column, digits: int = 3) -> Column:
    """`test (train)`, each with a fixed number of decimals."""
    return F.format_string(f"%.{digits}f (%.{digits}f)", test.cast("double"), train.cast("double"))


def metrics_summary(metrics: DataFrame, names: Sequence[str], model: str = "model", split: str = "split") -> DataFrame:
    """One row per model with `test (train)` texts, from one row per (model, split) of numbers."""
    def on(part: str, name: str) -> Column:
        return F.max(F.when(col(split) == part, col(name)))

    return metrics.groupBy(col(model)).agg(*[side_by_side(on("test", n), on("train", n)).alias(n) for n in names])


def write_markdown(summary: DataFrame, path: str) -> None:
    """Write a small summary (one row per model) as a Markdown table."""
    names = summary.columns
    line = lambda cells: F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    spark = summary.sparkSession
    head = spark.createDataFrame(
        [(0, "| " + " | ".join(names) + " |"), (1, "|" + "|".join("---" for _ in names) + "|")], "place int, value string"
    )
    body = summary.select(F.lit(2).alias("place"), line([F.coalesce(col(n).cast("string"), F.lit("")) for n in names]).alias("value"))
    head.unionByName(body).coalesce(1).sortWithinPartitions("place", "value").select("value").write.mode("overwrite").text(path)


def write_importances(importances: DataFrame, path: str) -> None:
    """Write (model, feature, importance) as CSV, the most important feature of each model first."""
    (
        importances.repartition("model").sortWithinPartitions("model", F.desc("importance"), "feature")
        .write.mode("overwrite").option("header", True).csv(path)
    )
