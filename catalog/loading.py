"""Sources, sinks and the load report."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import DIRTY, dirty, query, table
from tallyloom.session import scratch_path
from tallyloom.sources import files, report, sinks, sql

ORDERS_TEXT = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
       CASE WHEN o_orderkey % 17 = 0 OR o_orderkey % 19 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders
"""


def _orders(spark, sf):
    """Orders with texts that stand for a missing cell."""
    key = F.col("o_orderkey")
    priority = F.when(key % 17 == 0, "N/A").when(key % 19 == 0, "null").otherwise(F.col("o_orderpriority"))
    return table(spark, sf, "orders").withColumns({
        "o_orderdate": F.date_format("o_orderdate", "yyyy-MM-dd"), "o_orderpriority": priority,
    })


@query("load_csv", sql=ORDERS_TEXT)
def load_csv(spark, sf):
    path = scratch_path(spark, "csv")
    _orders(spark, sf).write.option("header", True).csv(path)
    return files.load_csv(spark, path)


@query("load_csv_with_schema", sql=ORDERS_TEXT)
def load_csv_with_schema(spark, sf):
    path = scratch_path(spark, "csv")
    _orders(spark, sf).write.option("header", True).csv(path)
    schema = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate string, "
              "o_orderpriority string")
    return files.load_csv(spark, path, schema=schema)


@query("load_parquet", sql="SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def load_parquet(spark, sf):
    return files.load_parquet(spark, f"{sf}/customer.parquet")


PARTS = "SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part"


@query("load_json_lines", sql=PARTS)
def load_json_lines(spark, sf):
    path = scratch_path(spark, "jsonl")
    table(spark, sf, "part").write.json(path)
    return files.load_json(spark, path, orient="lines")


ROWS_PER_FILE = 500


@query("load_json_records", sql=PARTS)
def load_json_records(spark, sf):
    """Files of one array of objects each, a fixed number of rows per file."""
    path = scratch_path(spark, "json")
    part = table(spark, sf, "part")
    row = F.struct(*[F.col(c) for c in part.columns])
    place = F.floor(F.col("p_partkey") / ROWS_PER_FILE).alias("g")
    arrays = part.groupBy(place).agg(F.to_json(F.collect_list(row)).alias("value"))
    arrays.write.partitionBy("g").text(path)
    return files.load_json(spark, f"{path}/*/", orient="records")


@query("load_json_columns", sql="SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier")
def load_json_columns(spark, sf):
    """Files of one object each, {column: {row label: value}}, a fixed number of rows per file."""
    path = scratch_path(spark, "json")
    supplier = table(spark, sf, "supplier")
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in supplier.columns])
    place = F.floor(F.col("s_suppkey") / ROWS_PER_FILE).alias("g")
    long = supplier.select(place, F.col("s_suppkey").cast("string").alias("row"), F.inline(cells))
    columns = long.groupBy("g", "column").agg(F.map_from_entries(F.collect_list(F.struct("row", "v"))).alias("cells"))
    objects = columns.groupBy("g").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("column", "cells")))).alias("value"))
    objects.write.partitionBy("g").text(path)
    return files.load_json(spark, f"{path}/*/", orient="columns", schema=(
        "s_suppkey bigint, s_name string, s_nationkey bigint, s_acctbal double"))


@query("load_orc", sql="SELECT event_id, user_id, event_type, value, props FROM events")
def load_orc(spark, sf):
    path = scratch_path(spark, "orc")
    table(spark, sf, "events").drop("ts").write.orc(path)
    return files.load_orc(spark, path)


def _write_feather(path: str):
    """Arrow batches of a partition → one Feather file; a helper to have files to read."""
    def write(batches):
        import uuid

        import pyarrow as pa
        from pyarrow import fs

        filesystem, inner = fs.FileSystem.from_uri(path)
        filesystem.create_dir(inner, recursive=True)
        writer, rows = None, 0
        for batch in batches:
            if writer is None:
                sink = filesystem.open_output_stream(f"{inner}/{uuid.uuid4().hex}.feather")
                writer = pa.ipc.new_file(sink, batch.schema)
            writer.write_batch(batch)
            rows += batch.num_rows
        if writer is not None:
            writer.close()
            sink.close()
        yield pa.RecordBatch.from_pydict({"rows": [rows]})

    return write


@query("load_feather", sql="SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def load_feather(spark, sf):
    path = scratch_path(spark, "feather")
    uri = path if "://" in path or path.startswith("file:") else f"file://{path}"
    columns = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment"]
    table(spark, sf, "customer").select(*columns).repartition(3).mapInArrow(_write_feather(uri), "rows long").agg(F.sum("rows")).collect()
    return files.load_feather(spark, uri)


REVENUE = """
SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
FROM {lineitem} WHERE l_quantity < 40 GROUP BY l_returnflag, l_linestatus
"""


@query("run_sql", sql=REVENUE.replace("{lineitem}", "lineitem"))
def run_sql(spark, sf):
    return sql.run_sql(spark, REVENUE, {"lineitem": table(spark, sf, "lineitem")})


_WIDTHS = {"unnamed_0": 8, "age": 8, "comorbidities": 8, "number_of_previous_admissions": 8}
_COLUMNS = ["unnamed_0", "age", "gender", "comorbidities", "length_of_stay", "medication_adherence",
            "socioeconomic_status", "smoking_status", "number_of_previous_admissions", "risk_category"]
SIZE_SQL = " + ".join(f"{_WIDTHS[c]} * count({c})" if c in _WIDTHS else f"coalesce(sum(strlen({c})), 0)" for c in _COLUMNS)
GAPS = [f"count(*) - count({c})" for c in _COLUMNS]


@query("load_report", sql=DIRTY + f""",
m AS (SELECT count(*) AS n, {" + ".join(f"({g})" for g in GAPS)} AS cells,
      {" + ".join(f"CAST(({g}) > 0 AS INT)" for g in GAPS)} AS with_gap, {SIZE_SQL} AS bytes FROM dirty),
d AS (SELECT count(*) AS k FROM (SELECT DISTINCT * FROM dirty))
SELECT CAST(n AS BIGINT) AS "rows", CAST(10 AS BIGINT) AS "columns", CAST(with_gap AS BIGINT) AS columns_with_missing,
       round(with_gap * 100.0 / 10, 2) AS pct_columns_with_missing, CAST(cells AS BIGINT) AS missing_cells,
       round(CAST(cells AS DOUBLE) * 100 / (n * 10), 2) AS pct_missing_cells, CAST(n - k AS BIGINT) AS duplicate_rows,
       CAST(bytes AS BIGINT) AS bytes, n = 0 AS is_empty FROM m, d
""")
def load_report(spark, sf):
    return report.load_report(dirty(spark, sf))


@query("metrics_summary", sql="""
WITH m AS (
  SELECT l_shipmode AS model, split, round(avg(q), 9) AS mean_quantity, round(avg(p), 9) AS mean_price FROM (
    SELECT l_returnflag AS l_shipmode, CASE WHEN l_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS split,
           l_quantity AS q, l_extendedprice AS p FROM lineitem) GROUP BY ALL)
SELECT model, printf('%.3f (%.3f)', max(CASE WHEN split = 'test' THEN mean_quantity END),
                     max(CASE WHEN split = 'train' THEN mean_quantity END)) AS mean_quantity,
       printf('%.3f (%.3f)', max(CASE WHEN split = 'test' THEN mean_price END),
              max(CASE WHEN split = 'train' THEN mean_price END)) AS mean_price
FROM m GROUP BY model
""")
def metrics_summary(spark, sf):
    split = F.when(F.col("l_orderkey") % 5 == 0, "test").otherwise("train")
    numbers = table(spark, sf, "lineitem").groupBy(F.col("l_returnflag").alias("model"), split.alias("split")).agg(
        F.round(F.avg("l_quantity"), 9).alias("mean_quantity"), F.round(F.avg("l_extendedprice"), 9).alias("mean_price"))
    return sinks.metrics_summary(numbers, ["mean_quantity", "mean_price"])
