"""Sorted distinct values of text columns with their rank, as a table of any length."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.columns import col
from tallyloom.session import scratch_path


def dictionary(df: DataFrame, values: Mapping[str, Column]) -> DataFrame:
    """(column, value, code): for each named expression its distinct values, numbered from 0 in ascending order.

    One table for all columns. Values are made distinct in every task before they are sent, sorted in ranges, and numbered
    within a range; the driver sees the sizes of the ranges only. A heavy value is one entry, so a range is as long as any
    other. NULL has no code. The table is written to the shared folder, parted by column.
    """
    spark = df.sparkSession
    places = {name: i for i, name in enumerate(values)}
    cells = F.array(*[F.struct(F.lit(places[n]).alias("place"), v.cast("string").alias("value")) for n, v in values.items()])
    distinct = df.select(F.explode(cells).alias("c")).select("c.*").filter("value IS NOT NULL").distinct()
    path = scratch_path(spark, "sorted-values")
    ranged = distinct.repartitionByRange("place", "value").sortWithinPartitions("place", "value")
    # The number of the task in the high bits, that of the row within it in the low ones.
    ranged.select("place", "value", F.monotonically_increasing_id().alias("at")).write.parquet(path)
    rows = spark.read.parquet(path).withColumns({"part": F.shiftright("at", 33), "at": F.col("at").bitwiseAND((1 << 33) - 1)})
    sizes = rows.groupBy("place", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).orderBy("place", "part").collect()
    before: dict[int, int] = {}
    starts = []
    for r in sizes:
        starts.append((r["place"], r["part"], before.get(r["place"], 0) - r["first"]))
        before[r["place"]] = before.get(r["place"], 0) + r["n"]
    shift = F.broadcast(spark.createDataFrame(starts, "place int, part long, shift long"))  # one row a task, and one a column
    coded = scratch_path(spark, "dictionary")
    rows.join(shift, ["place", "part"]).select("place", "value", (F.col("at") + F.col("shift")).alias("code")).write.partitionBy("place").parquet(coded)
    names = F.create_map(*[x for n, i in places.items() for x in (F.lit(i), F.lit(n))])
    return spark.read.schema("value string, code long, place int").parquet(coded).select(names[F.col("place")].alias("column"), "place", "value", "code")


def ranked(df: DataFrame, order: list[str], name: str = "rank") -> DataFrame:
    """The frame with the place of each row, from 0, in ascending order of some columns: ranges are sorted, their sizes carried."""
    path = scratch_path(df.sparkSession, "ranked")
    df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    rows = df.sparkSession.read.parquet(path).withColumns({"_part": F.shiftright("_at", 33), "_at": F.col("_at").bitwiseAND((1 << 33) - 1)})
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    starts, total = [], 0
    for r in parts:
        starts.append((r["_part"], total))
        total += r["n"]
    shift = F.broadcast(df.sparkSession.createDataFrame(starts, "_part long, _before long"))  # one row a task
    return rows.join(shift, "_part").withColumn(name, F.col("_at") + F.col("_before")).drop("_part", "_at", "_before")


def sizes(table: DataFrame) -> dict[str, int]:
    """How many values each column has; one that has none is missing."""
    return {r["column"]: r["n"] for r in table.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}


def coded(df: DataFrame, table: DataFrame, place: int, value: Column, name: str, unknown: Column) -> DataFrame:
    """The frame with the code of a value; `unknown` for a value that has none. A join, which Spark broadcasts if the table is small."""
    own = table.filter(F.col("place") == place).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    joined = df.withColumn("_own", value.cast("string")).join(own, F.col("_own") == F.col("_value"), "left")
    return joined.withColumn(name, F.coalesce(F.col("_code").cast("double"), unknown)).drop("_own", "_value", "_code")
