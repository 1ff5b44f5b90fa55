"""Query registration and the inputs the queries share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, its oracle."""
    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The readmission table with every kind of dirt, derived from orders by text both engines run.
DIRTY = """
WITH base AS (
  SELECT o_orderkey AS unnamed_0,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL
         WHEN o_orderkey % 41 = 0 THEN -CAST(o_custkey % 90 AS DOUBLE) - 1
         WHEN o_orderkey % 43 = 0 THEN CAST(150 AS DOUBLE)
         ELSE CAST(o_custkey % 90 AS DOUBLE) END AS age,
    CASE WHEN o_orderkey % 89 = 0 THEN NULL
         WHEN o_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
    CASE WHEN o_orderkey % 59 = 0 THEN NULL
         WHEN o_orderkey % 61 = 0 THEN CAST(-3 AS DOUBLE)
         WHEN o_orderkey % 53 = 0 THEN CAST(28 AS DOUBLE)
         ELSE CAST(o_orderkey % 6 AS DOUBLE) END AS comorbidities,
    CASE WHEN o_orderkey % 83 = 0 THEN NULL
         ELSE CAST(o_custkey % 14 + 1 AS STRING) || ' days' END AS length_of_stay,
    CASE WHEN o_orderkey % 79 = 0 THEN NULL
         WHEN o_orderkey % 3 = 0 THEN CASE WHEN o_orderkey % 5 = 0 THEN 'Lo' ELSE 'Low' END
         WHEN o_orderkey % 3 = 1 THEN CASE WHEN o_orderkey % 7 = 0 THEN 'Mediu' ELSE 'Medium' END
         ELSE CASE WHEN o_orderkey % 11 = 0 THEN 'Hig' ELSE 'High' END END AS medication_adherence,
    CASE WHEN o_orderkey % 17 = 0 THEN 'unknown' ELSE o_orderpriority END AS socioeconomic_status,
    CASE WHEN o_orderstatus = 'F' THEN 'Yes' WHEN o_orderkey % 13 = 0 THEN ' no' ELSE 'No' END AS smoking_status,
    CASE WHEN o_orderkey % 73 = 0 THEN NULL
         WHEN o_orderkey % 71 = 0 THEN CAST(40 AS DOUBLE)
         ELSE CAST(o_custkey % 9 AS DOUBLE) END AS number_of_previous_admissions,
    CASE WHEN o_orderkey % 101 = 0 THEN NULL
         WHEN o_totalprice > 350000 THEN 'High-risk' ELSE 'Low-risk' END AS risk_category
  FROM orders),
dirty AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE unnamed_0 % 500 = 0)
"""

# Names as they stand in the raw file.
RAW_NAMES = [
    "Unnamed: 0", "Age", "Gender", "Comorbidities", "Length of Stay", "Medication Adherence", "Socioeconomic Status",
    "Smoking Status", "Number of Previous Admissions", "Risk_Category",
]

# The same table after cleaning, as SQL.
CLEANED = DIRTY + """,
cleaned AS (
  SELECT unnamed_0 AS id, age, gender, comorbidities, CAST(replace(length_of_stay, ' days', '') AS BIGINT) AS length_of_stay,
    CASE medication_adherence WHEN 'Lo' THEN 'Low' WHEN 'Mediu' THEN 'Medium' WHEN 'Hig' THEN 'High'
         ELSE medication_adherence END AS medication_adherence,
    socioeconomic_status, smoking_status, number_of_previous_admissions,
    CASE risk_category WHEN 'Low-risk' THEN 0 ELSE 1 END AS risk_category
  FROM dirty
  WHERE risk_category IS NOT NULL AND age IS NOT NULL AND age BETWEEN 0 AND 105 AND gender IS NOT NULL
    AND comorbidities IS NOT NULL AND comorbidities BETWEEN 0 AND 20 AND length_of_stay IS NOT NULL
    AND medication_adherence IS NOT NULL AND number_of_previous_admissions IS NOT NULL
    AND number_of_previous_admissions BETWEEN 0 AND 15)
"""

# Scored tables for the metrics, with many equal scores.
BINARY = """
SELECT l_orderkey, l_linenumber, CAST(l_linestatus = 'F' AS INT) AS hit,
       round(l_discount * 5 + l_tax * 5, 2) AS score,
       CASE WHEN l_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS split
FROM lineitem
"""
MULTICLASS = """
SELECT l_orderkey, l_linenumber, l_returnflag AS label, l_discount * 10 AS score_a, l_tax * 10 AS score_n,
       l_quantity / 50 AS score_r,
       CASE WHEN l_discount * 10 >= l_tax * 10 AND l_discount * 10 >= l_quantity / 50 THEN 'A'
            WHEN l_tax * 10 >= l_quantity / 50 THEN 'N' ELSE 'R' END AS prediction,
       CASE WHEN l_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS split
FROM lineitem
"""
REGRESSION = """
SELECT l_orderkey, l_linenumber, l_extendedprice AS actual, l_quantity * 2100 AS predicted,
       CASE WHEN l_orderkey % 5 = 0 THEN 'test' ELSE 'train' END AS split
FROM lineitem
"""


def _run(spark: SparkSession, sf_dir: str, source: str, text: str) -> DataFrame:
    return spark.sql(text.replace(f"FROM {source}", "FROM {source}"), source=table(spark, sf_dir, source))


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, "orders", DIRTY + "SELECT * FROM dirty")


def raw_admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty(spark, sf_dir).toDF(*RAW_NAMES)


def binary_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, "lineitem", BINARY)


def multiclass_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, "lineitem", MULTICLASS)


def regression_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, "lineitem", REGRESSION)
