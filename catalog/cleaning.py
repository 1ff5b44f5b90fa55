"""Column, row and cell cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import CLEANED, DIRTY, RAW_NAMES, dirty, query, raw_admissions, table
from tallyloom.functions.naming import snake_case
from tallyloom.operators import bivariate, clean, schema
from tallyloom.operators.steps import DropRepeats, count_changes
from tallyloom.plans.cleaning import admissions_plan

RENAMED = ", ".join(f"{a} AS {snake_case(b)}" for a, b in zip(
    ["unnamed_0", "age", "gender", "comorbidities", "length_of_stay", "medication_adherence", "socioeconomic_status",
     "smoking_status", "number_of_previous_admissions", "risk_category"], RAW_NAMES))


@query("snake_case_names", sql=DIRTY + f"SELECT {RENAMED} FROM dirty")
def snake_case_names(spark, sf):
    return schema.convert_column_names_to_snake_case(raw_admissions(spark, sf))


@query("convert_columns_dtype", sql=DIRTY + """
SELECT unnamed_0, TRY_CAST(medication_adherence AS DOUBLE) AS medication_adherence, CAST(age AS BIGINT) AS age,
       length_of_stay, TRY_CAST(replace(length_of_stay, ' days', '') AS DOUBLE) AS stay
FROM dirty
""")
def convert_columns_dtype(spark, sf):
    stay = F.replace(F.col("length_of_stay"), F.lit(" days"), F.lit(""))
    rows = dirty(spark, sf).select("unnamed_0", "medication_adherence", "age", "length_of_stay", stay.alias("stay"))
    return schema.convert_columns_dtype(
        rows, {"medication_adherence": "numeric", "age": int, "length_of_stay": int, "stay": "numeric", "absent": int})


@query("convert_columns_to_datetime", sql="""
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y/%m/%d') END AS day FROM orders
""")
def convert_columns_to_datetime(spark, sf):
    text = F.when(F.col("o_orderkey") % 7 == 0, "not a date").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    rows = table(spark, sf, "orders").select("o_orderkey", text.alias("day"))
    parsed = schema.convert_columns_dtype(rows, {"day": "datetime"})
    return parsed.withColumn("day", F.date_format("day", "yyyy/MM/dd"))


@query("convert_columns_by_dtype", sql="""
SELECT p_partkey, p_name, p_brand, p_type, CAST(p_size AS VARCHAR) AS p_size, p_retailprice FROM part
""")
def convert_columns_by_dtype(spark, sf):
    return schema.convert_columns_by_dtype(table(spark, sf, "part"), "int32", "string")


@query("move_column_before", sql="SELECT c_acctbal, c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def move_column_before(spark, sf):
    return schema.move_column_before(table(spark, sf, "customer"), "c_acctbal", "c_custkey")


@query("drop_irrelevant_features", sql="SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def drop_irrelevant_features(spark, sf):
    return schema.drop_irrelevant_features(table(spark, sf, "customer"), ["c_name", "c_acctbal", "not_there"])


@query("drop_duplicate_rows", sql=DIRTY + "SELECT DISTINCT * FROM dirty")
def drop_duplicate_rows(spark, sf):
    return clean.drop_duplicate_rows(dirty(spark, sf))


@query("drop_duplicates_by_subset", sql=DIRTY + """
SELECT unnamed_0, gender, medication_adherence, age FROM (
  SELECT *, row_number() OVER (PARTITION BY gender, medication_adherence, age ORDER BY unnamed_0) AS rn FROM dirty)
WHERE rn = 1
""")
def drop_duplicates_by_subset(spark, sf):
    rows = dirty(spark, sf).select("unnamed_0", "gender", "medication_adherence", "age")
    return clean.drop_duplicate_rows(rows, ["gender", "medication_adherence", "age"], order_by="unnamed_0")


@query("drop_duplicate_ids", sql="""
SELECT o_custkey, min(o_orderkey) AS o_orderkey, arg_min(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY o_custkey
""")
def drop_duplicate_ids(spark, sf):
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return clean.drop_duplicate_ids(rows, "o_custkey", order_by="o_orderkey")


@query("list_duplicates", sql=DIRTY + "SELECT * FROM dirty WHERE unnamed_0 IN (SELECT unnamed_0 FROM dirty GROUP BY 1 HAVING count(*) > 1)")
def list_duplicates(spark, sf):
    return clean.list_duplicates(dirty(spark, sf))


@query("drop_missing_values", sql=DIRTY + "SELECT * FROM dirty WHERE age IS NOT NULL AND gender IS NOT NULL")
def drop_missing_values(spark, sf):
    return clean.drop_missing_values(dirty(spark, sf), ["age", "gender", "not_there"])


@query("drop_missing_any_column", sql=DIRTY + """
SELECT * FROM dirty WHERE age IS NOT NULL AND gender IS NOT NULL AND comorbidities IS NOT NULL AND length_of_stay IS NOT NULL
  AND medication_adherence IS NOT NULL AND number_of_previous_admissions IS NOT NULL AND risk_category IS NOT NULL
""")
def drop_missing_any_column(spark, sf):
    return clean.drop_missing_values(dirty(spark, sf))


@query("remove_missing_any", sql=DIRTY + """
SELECT * FROM dirty WHERE age IS NOT NULL AND socioeconomic_status <> 'unknown'
""")
def remove_missing_any(spark, sf):
    return clean.remove_missing_values(
        dirty(spark, sf), "any", ["age", "socioeconomic_status"], {"socioeconomic_status": ["unknown"]})


@query("remove_missing_all", sql=DIRTY + """
SELECT unnamed_0, age, gender, CASE WHEN socioeconomic_status = 'unknown' THEN NULL ELSE socioeconomic_status END AS socioeconomic_status
FROM dirty WHERE age IS NOT NULL OR socioeconomic_status <> 'unknown'
""")
def remove_missing_all(spark, sf):
    rows = dirty(spark, sf).select("unnamed_0", "age", "gender", "socioeconomic_status")
    return clean.remove_missing_values(
        rows, "all", ["age", "socioeconomic_status"], {"socioeconomic_status": ["unknown"], "not_there": [1]})


@query("mark_missing_values", sql=DIRTY + """
SELECT unnamed_0, coalesce(age, -1) AS age, coalesce(comorbidities, -1) AS comorbidities, coalesce(gender, 'missing') AS gender,
       coalesce(risk_category, 'missing') AS risk_category, length_of_stay
FROM dirty
""")
def mark_missing_values(spark, sf):
    rows = dirty(spark, sf).select("unnamed_0", "age", "comorbidities", "gender", "risk_category", "length_of_stay")
    return clean.mark_missing_values(rows, ["age", "comorbidities"], ["gender", "risk_category"])


@query("remove_out_of_range", sql=DIRTY + """
SELECT unnamed_0, age, comorbidities FROM dirty WHERE (age IS NULL OR age BETWEEN 0 AND 105) AND (comorbidities IS NULL OR comorbidities <= 20)
""")
def remove_out_of_range(spark, sf):
    rows = dirty(spark, sf).select("unnamed_0", "age", "comorbidities")
    return clean.remove_out_of_range(clean.remove_out_of_range(rows, "age", 0, 105), "comorbidities", max_value=20)


@query("absolute_values", sql="SELECT c_custkey, c_name, abs(c_acctbal) AS c_acctbal FROM customer")
def absolute_values(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return clean.get_absolute_values(rows, ["c_acctbal", "c_name", "not_there"])


@query("map_values", sql=DIRTY + """
SELECT unnamed_0, CASE medication_adherence WHEN 'Lo' THEN 'Low' WHEN 'Mediu' THEN 'Medium' WHEN 'Hig' THEN 'High'
       ELSE medication_adherence END AS medication_adherence, risk_category,
       CASE socioeconomic_status WHEN '1-URGENT' THEN 'top' WHEN '2-HIGH' THEN 'top' ELSE 'rest' END AS level,
       socioeconomic_status, CASE risk_category WHEN 'Low-risk' THEN 0 WHEN 'High-risk' THEN 1 END AS risk
FROM dirty
""")
def map_values(spark, sf):
    rows = dirty(spark, sf).select("unnamed_0", "medication_adherence", "socioeconomic_status", "risk_category")
    rows = clean.map_values(rows, {"medication_adherence": {"Lo": "Low", "Mediu": "Medium", "Hig": "High"}})
    rows = clean.map_values(rows, {"socioeconomic_status": {"1-URGENT": "top", "2-HIGH": "top"}}, new_col="level", default="rest")
    return clean.map_values(rows, {"risk_category": {"Low-risk": 0, "High-risk": 1}}, new_col="risk")


@query("map_values_from_table", sql="""
SELECT c_custkey, c_mktsegment, coalesce(n_name, 'elsewhere') AS nation
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) ON c_nationkey = n_nationkey
""")
def map_values_from_table(spark, sf):
    nation = table(spark, sf, "nation").filter("n_nationkey < 20")
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    return clean.map_from_table(
        rows, "c_nationkey", nation, "n_nationkey", "n_name", new_col="nation", default="elsewhere").drop("c_nationkey")


@query("map_values_large", sql="""
SELECT c_custkey, CASE WHEN c_custkey % 1500 BETWEEN 1 AND 1400 THEN CAST(c_custkey % 1500 AS INT) * 2 ELSE NULL END AS label FROM customer
""")
def map_values_large(spark, sf):
    """Texts mapped to numbers by a map of 1,400 entries; labels it lacks are not numbers and become NULL."""
    rows = table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("label "), F.col("c_custkey") % 1500).alias("label"))
    return clean.map_values(rows, {"label": {f"label {i}": 2 * i for i in range(1, 1401)}})


@query("unmapped_values", sql=DIRTY + """
SELECT DISTINCT medication_adherence FROM dirty WHERE medication_adherence NOT IN ('Lo', 'Mediu', 'Hig')
""")
def unmapped_values(spark, sf):
    return clean.unmapped_values(dirty(spark, sf), "medication_adherence", {"Lo": "Low", "Mediu": "Medium", "Hig": "High"})


@query("lowercase_text", sql="SELECT doc_id, lower(text) AS text, lang FROM documents")
def lowercase_text(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return clean.convert_text_to_lowercase(rows, ["text", "doc_id"])


@query("replace_character", sql="SELECT doc_id, replace(text, '.', ' ;') AS text FROM documents")
def replace_character(spark, sf):
    return clean.replace_character(table(spark, sf, "documents").select("doc_id", "text"), ".", " ;", ["text", "doc_id"])


@query("clean_all", sql=CLEANED + """
SELECT age, gender, comorbidities, length_of_stay, medication_adherence, socioeconomic_status, smoking_status,
       number_of_previous_admissions, risk_category FROM cleaned
""")
def clean_all(spark, sf):
    return admissions_plan().clean_all(raw_admissions(spark, sf))


@query("clean_one_group", sql=DIRTY + "SELECT * FROM dirty WHERE age IS NOT NULL AND age BETWEEN 0 AND 105")
def clean_one_group(spark, sf):
    return admissions_plan().clean_all(dirty(spark, sf), "clean_age")


@query("clean_then_summarise", sql=CLEANED + """
SELECT risk_category, CAST(count(*) AS BIGINT) AS n, round(avg(age), 6) AS mean, round(quantile_cont(age, 0.5), 6) AS median,
       round(stddev_samp(age), 6) AS std FROM cleaned GROUP BY risk_category
""")
def clean_then_summarise(spark, sf):
    """The flagship: clean the raw table, then age by risk."""
    cleaned = admissions_plan().clean_all(raw_admissions(spark, sf))
    return bivariate.numeric_by_category(cleaned, "age", "risk_category").select(
        "risk_category", "n", *[F.round(c, 6).alias(c) for c in ("mean", "median", "std")])


def _report_rows():
    """(step, name, column, metric, rows alive before the step, rows it hits) for the whole plan."""
    alive = ["TRUE"]
    rows = []

    def drop(step, name, hit):
        rows.append((step, name, "", "rows_dropped", " AND ".join(alive), hit))
        alive.append(f"NOT ({hit})")

    def change(step, name, column, hit):
        rows.append((step, name, column, "values_changed", " AND ".join(alive), hit))

    drop(3, "drop_missing_values", "risk_category IS NULL")
    change(4, "map_values", "risk_category", "TRUE")
    drop(5, "drop_missing_values", "age IS NULL")
    drop(6, "remove_out_of_range", "age NOT BETWEEN 0 AND 105")
    drop(7, "drop_missing_values", "gender IS NULL")
    drop(8, "drop_missing_values", "comorbidities IS NULL")
    drop(9, "remove_out_of_range", "comorbidities NOT BETWEEN 0 AND 20")
    drop(10, "drop_missing_values", "length_of_stay IS NULL")
    change(11, "replace_character", "length_of_stay", "contains(length_of_stay, ' days')")
    drop(13, "drop_missing_values", "medication_adherence IS NULL")
    change(14, "map_values", "medication_adherence", "medication_adherence IN ('Lo', 'Mediu', 'Hig')")
    drop(15, "drop_missing_values", "number_of_previous_admissions IS NULL")
    drop(16, "remove_out_of_range", "number_of_previous_admissions NOT BETWEEN 0 AND 15")
    return rows


@query("step_change_report", sql=DIRTY + "\nUNION ALL ".join(
    f"SELECT {no} AS step_no, '{step}' AS step, '{column}' AS \"column\", '{metric}' AS metric, "
    f"CAST(count(*) FILTER (WHERE {alive} AND ({hit})) AS BIGINT) AS value FROM dirty"
    for no, step, column, metric, alive, hit in _report_rows()))
def step_change_report(spark, sf):
    return admissions_plan().report(raw_admissions(spark, sf))


@query("step_report_with_duplicates", sql=DIRTY + """
SELECT 1 AS step_no, 'drop_duplicate_rows' AS step, '' AS "column", 'rows_dropped' AS metric,
       CAST((SELECT count(*) FROM dirty) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty)) AS BIGINT) AS value
UNION ALL
SELECT 2, 'convert_text_to_lowercase', 'gender', 'values_changed', CAST(count(*) FILTER (WHERE gender IS NOT NULL) AS BIGINT)
FROM (SELECT DISTINCT * FROM dirty)
""")
def step_report_with_duplicates(spark, sf):
    steps = [DropRepeats("drop_duplicate_rows", clean.drop_duplicate_rows), clean.lowercase_step(["gender"])]
    return count_changes(dirty(spark, sf), steps)
