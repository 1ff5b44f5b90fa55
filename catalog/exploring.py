"""Inspection, description, outliers, frequencies, missingness, profile and table comparison."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from catalog.registry import CLEANED, DIRTY, dirty, query, raw_admissions, table
from tallyloom.operators import changes, compare, profile
from tallyloom.plans.cleaning import admissions_plan

DIRTY_COLUMNS = ["unnamed_0", "age", "gender", "comorbidities", "length_of_stay", "medication_adherence",
                 "socioeconomic_status", "smoking_status", "number_of_previous_admissions", "risk_category"]
DIRTY_TYPES = dict.fromkeys(DIRTY_COLUMNS, "string") | {
    "unnamed_0": "bigint", "age": "double", "comorbidities": "double", "number_of_previous_admissions": "double"}
NUMBERS = ["unnamed_0", "age", "comorbidities", "number_of_previous_admissions"]


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def union(parts):
    return "\nUNION ALL ".join(parts)


@query("shape", sql=DIRTY + 'SELECT CAST(count(*) AS BIGINT) AS "rows", CAST(10 AS BIGINT) AS "columns" FROM dirty')
def shape(spark, sf):
    return profile.shape(dirty(spark, sf))


@query("head", sql="SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_custkey LIMIT 5")
def head(spark, sf):
    return profile.head(table(spark, sf, "customer"), "c_custkey").select("c_custkey", "c_name", "c_acctbal")


@query("tail", sql="SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_custkey DESC LIMIT 5")
def tail(spark, sf):
    return profile.tail(table(spark, sf, "customer"), "c_custkey").select("c_custkey", "c_name", "c_acctbal")


@query("info", sql=DIRTY + union(
    f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS \"column\", '{DIRTY_TYPES[c]}' AS type, CAST(count({c}) AS BIGINT) AS non_null FROM dirty"
    for i, c in enumerate(DIRTY_COLUMNS)))
def info(spark, sf):
    return profile.info(dirty(spark, sf))


@query("sample_rows", sql="""
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY substr(md5(CAST(o_orderkey AS VARCHAR) || ':42'), 1, 13) LIMIT 5
""")
def sample_rows(spark, sf):
    return profile.sample_rows(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"])


@query("describe", sql=DIRTY + union(f"""
SELECT '{c}' AS "column", CAST(count({c}) AS BIGINT) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
       CAST(min({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50,
       quantile_cont({c}, 0.75) AS q75, CAST(max({c}) AS DOUBLE) AS max FROM dirty""" for c in NUMBERS))
def describe(spark, sf):
    return rounded(profile.describe(dirty(spark, sf)), "mean", "std")


@query("distinct_counts", sql=DIRTY + union(
    f"SELECT '{c}' AS \"column\", CAST(count(DISTINCT {c}) AS BIGINT) AS \"distinct\" FROM dirty" for c in DIRTY_COLUMNS))
def distinct_counts(spark, sf):
    return profile.distinct_counts(dirty(spark, sf))


@query("distinct_values", sql=DIRTY + "SELECT DISTINCT medication_adherence FROM dirty WHERE medication_adherence IS NOT NULL")
def distinct_values(spark, sf):
    return profile.distinct_values(dirty(spark, sf), "medication_adherence")


@query("skewness_and_kurtosis", sql=union(f"""
SELECT '{c}' AS "column", round(skewness({c}), 6) AS skewness, round(kurtosis({c}), 6) AS kurtosis,
       abs(skewness({c})) > 1 AS skewed, kurtosis({c}) > 3 AS heavy_tailed FROM {t}"""
    for c, t in (("value", "events"), ("l_extendedprice", "lineitem"), ("l_quantity", "lineitem"))))
def skewness_and_kurtosis(spark, sf):
    events = profile.shape_statistics(table(spark, sf, "events"), ["value"])
    items = profile.shape_statistics(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"])
    return rounded(events.unionByName(items), "skewness", "kurtosis")


IQR = """
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events),
b AS (SELECT q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM q)
"""


@query("outliers_iqr", sql=IQR + "SELECT event_id, user_id, event_type, value FROM events, b WHERE value < low OR value > high")
def outliers_iqr(spark, sf):
    return profile.iqr_outliers(table(spark, sf, "events").select("event_id", "user_id", "event_type", "value"), "value")


@query("inliers_iqr", sql=IQR + "SELECT event_id, value FROM events, b WHERE value > low AND value < high")
def inliers_iqr(spark, sf):
    return profile.iqr_inliers(table(spark, sf, "events").select("event_id", "value"), "value")


@query("outliers_zscore", sql="""
WITH m AS (SELECT avg(value) AS a, stddev_pop(value) AS s FROM events)
SELECT event_id, event_type, value FROM events, m WHERE abs(value - a) > 3 * s
""")
def outliers_zscore(spark, sf):
    return profile.zscore_outliers(table(spark, sf, "events").select("event_id", "event_type", "value"), "value")


@query("outlier_report", sql=IQR + """
SELECT 'value' AS "column", 'iqr' AS method, round(any_value(low), 6) AS lower, round(any_value(high), 6) AS upper,
       CAST(count(*) FILTER (WHERE value < low OR value > high) AS BIGINT) AS outliers,
       round(CAST(count(*) FILTER (WHERE value < low OR value > high) AS DOUBLE) * 100 / count(*), 2) AS pct_rows FROM events, b
UNION ALL
SELECT 'l_tax', 'zscore', round(avg(l_tax) - 3 * stddev_samp(l_tax), 6), round(avg(l_tax) + 3 * stddev_samp(l_tax), 6),
       CAST(count(*) FILTER (WHERE abs(l_tax - a) > 3 * s) AS BIGINT),
       round(CAST(count(*) FILTER (WHERE abs(l_tax - a) > 3 * s) AS DOUBLE) * 100 / count(*), 2)
FROM lineitem, (SELECT avg(l_tax) AS a, stddev_pop(l_tax) AS s FROM lineitem)
""")
def outlier_report(spark, sf):
    skewed = profile.outlier_report(table(spark, sf, "events"), "value")
    level = profile.outlier_report(table(spark, sf, "lineitem"), "l_tax")
    return rounded(skewed.unionByName(level), "lower", "upper")


@query("missing_summary", sql=DIRTY + union(f"""
SELECT '{c}' AS "column", '{DIRTY_TYPES[c]}' AS type, CAST(count(*) - count({c}) AS BIGINT) AS missing,
       CASE WHEN count({c}) = count(*) THEN '-'
            ELSE printf('%.2f', round(CAST(count(*) - count({c}) AS DOUBLE) * 100 / count(*), 2)) END AS pct FROM dirty"""
    for c in DIRTY_COLUMNS))
def missing_summary(spark, sf):
    return profile.missing_summary(dirty(spark, sf))


@query("sample_missing", sql=DIRTY + "SELECT unnamed_0, age, gender FROM dirty WHERE age IS NULL ORDER BY unnamed_0 LIMIT 5")
def sample_missing(spark, sf):
    return profile.sample_missing(dirty(spark, sf).select("unnamed_0", "age", "gender"), "age", "unnamed_0")


@query("frequency_table", sql=DIRTY + """
SELECT socioeconomic_status AS value, CAST(count(*) AS BIGINT) AS n,
       round(CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER (), 2) AS pct, round(count(*) / sum(count(*)) OVER (), 6) AS share
FROM dirty WHERE socioeconomic_status IS NOT NULL GROUP BY 1
""")
def frequency_table(spark, sf):
    return rounded(profile.frequency_table(dirty(spark, sf), "socioeconomic_status"), "share")


def _flags(column, source):
    return f"""
SELECT '{column}' AS "column", CAST(count(*) AS BIGINT) AS "distinct", count(*) = 1 AS is_constant, count(*) > 25 AS is_high_cardinality,
       CAST(count(*) FILTER (WHERE n / total < 0.01) AS BIGINT) AS rare_categories, bool_or(v <> trim(v)) AS has_blanks,
       count(DISTINCT lower(v)) < count(*) AS mixed_case
FROM (SELECT {column} AS v, count(*) AS n, sum(count(*)) OVER () AS total FROM {source} WHERE {column} IS NOT NULL GROUP BY 1)"""


@query("category_flags", sql=DIRTY + union(
    _flags(c, s) for c, s in (("smoking_status", "dirty"), ("length_of_stay", "dirty"), ("p_name", "part"), ("p_brand", "part"))))
def category_flags(spark, sf):
    rows, part = dirty(spark, sf), table(spark, sf, "part")
    out = profile.category_flags(rows, "smoking_status")
    for frame, column in ((rows, "length_of_stay"), (part, "p_name"), (part, "p_brand")):
        out = out.unionByName(profile.category_flags(frame, column))
    return out


@query("top_categories", sql="""
WITH f AS (SELECT source AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, source) AS rn FROM documents GROUP BY 1)
SELECT CASE WHEN rn <= 5 THEN value ELSE 'Others' END AS value, CAST(sum(n) AS BIGINT) AS n FROM f GROUP BY 1
""")
def top_categories(spark, sf):
    return profile.top_categories(table(spark, sf, "documents"), "source")


@query("histogram", sql="""
WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
c AS (SELECT least(CAST(floor((value - lo) / (hi - lo) * 30) AS BIGINT), 29) AS bin, count(*) AS n FROM events, s GROUP BY 1)
SELECT CAST(g.i AS BIGINT) AS bin, round(lo + g.i * ((hi - lo) / 30), 6) AS lower, round(lo + (g.i + 1) * ((hi - lo) / 30), 6) AS upper,
       CAST(coalesce(n, 0) AS BIGINT) AS n
FROM range(30) g(i) CROSS JOIN s LEFT JOIN c ON c.bin = g.i
""")
def histogram(spark, sf):
    return rounded(profile.histogram(table(spark, sf, "events"), "value"), "lower", "upper")


def _box(group, value, source, by):
    keys = f"{by} AS g," if by else "0 AS g,"
    return f"""
WITH r AS (SELECT {keys} {value} AS v FROM {source} WHERE {value} IS NOT NULL),
q AS (SELECT g, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3 FROM r GROUP BY g)
SELECT {"r.g AS " + group + "," if by else ""} CAST(count(*) AS BIGINT) AS n, round(any_value(q1), 6) AS q25, round(any_value(q2), 6) AS q50,
       round(any_value(q3), 6) AS q75, min(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
       max(v) FILTER (WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high,
       CAST(count(*) FILTER (WHERE NOT v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS BIGINT) AS outliers
FROM r JOIN q ON r.g = q.g GROUP BY r.g"""


@query("box_statistics", sql=_box("", "value", "events", None))
def box_statistics(spark, sf):
    return rounded(profile.box_statistics(table(spark, sf, "events"), "value"), "q25", "q50", "q75")


@query("box_statistics_by_group", sql=_box("event_type", "value", "events", "event_type"))
def box_statistics_by_group(spark, sf):
    return rounded(profile.box_statistics(table(spark, sf, "events"), "value", "event_type"), "q25", "q50", "q75")


_Z = ", ".join(f"({i / 100!r}, {NormalDist().inv_cdf(i / 100)!r})" for i in range(1, 100))


@query("qq_table", sql=f"""
WITH z(p, theoretical) AS (VALUES {_Z}), m AS (SELECT avg(value) AS a, stddev_samp(value) AS s FROM events),
l AS (SELECT list(value ORDER BY value) AS v, count(*) AS n FROM events)
SELECT CAST(p AS DOUBLE) AS p, round(CAST(theoretical AS DOUBLE), 6) AS theoretical,
       round(v[CAST(floor(p * (n - 1)) AS BIGINT) + 1] + (v[CAST(ceil(p * (n - 1)) AS BIGINT) + 1] - v[CAST(floor(p * (n - 1)) AS BIGINT) + 1])
             * (p * (n - 1) - floor(p * (n - 1))), 6) AS sample, round(a + s * CAST(theoretical AS DOUBLE), 6) AS line
FROM (SELECT CAST(p AS DOUBLE) AS p, theoretical FROM z), m, l
""")
def qq_table(spark, sf):
    return rounded(profile.qq_table(table(spark, sf, "events"), "value"), "theoretical", "sample", "line")


def _profile_row(c):
    kind = DIRTY_TYPES[c]
    if c in NUMBERS:
        numbers = f"""round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, CAST(min({c}) AS DOUBLE) AS min,
       CAST(max({c}) AS DOUBLE) AS max, round(skewness({c}), 6) AS skewness, round(kurtosis({c}), 6) AS kurtosis,
       CAST(count(*) FILTER (WHERE {c} = 0) AS BIGINT) AS zeros, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50,
       quantile_cont({c}, 0.75) AS q75, CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS top_count"""
    else:
        numbers = f"""CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max,
       CAST(NULL AS DOUBLE) AS skewness, CAST(NULL AS DOUBLE) AS kurtosis, CAST(0 AS BIGINT) AS zeros, CAST(NULL AS DOUBLE) AS q25,
       CAST(NULL AS DOUBLE) AS q50, CAST(NULL AS DOUBLE) AS q75,
       (SELECT {c} FROM dirty WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS top,
       (SELECT CAST(count(*) AS BIGINT) FROM dirty WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY 1 DESC LIMIT 1) AS top_count"""
    return f"""
SELECT '{c}' AS "column", '{kind}' AS type, CAST(count(*) AS BIGINT) AS "rows", CAST(count(*) - count({c}) AS BIGINT) AS missing,
       CAST(count(DISTINCT {c}) AS BIGINT) AS "distinct", round(CAST(count(*) - count({c}) AS DOUBLE) * 100 / count(*), 2) AS pct_missing,
       {numbers} FROM dirty"""


@query("profile", sql=DIRTY + union(_profile_row(c) for c in DIRTY_COLUMNS))
def profile_table(spark, sf):
    return rounded(profile.profile(dirty(spark, sf)), "mean", "std", "skewness", "kurtosis")


@query("missing_matrix", sql=DIRTY + f"""
SELECT unnamed_0, {", ".join(f"CAST({c} IS NULL AS INT) AS {c}" for c in DIRTY_COLUMNS[1:])} FROM dirty
""")
def missing_matrix(spark, sf):
    return profile.missing_matrix(dirty(spark, sf), ["unnamed_0"])


@query("missing_by_range", sql=DIRTY + """,
s AS (SELECT CAST(min(unnamed_0) AS DOUBLE) AS lo, CAST(max(unnamed_0) AS DOUBLE) AS hi FROM dirty),
r AS (SELECT least(CAST(floor((unnamed_0 - lo) / (hi - lo) * 50) AS BIGINT), 49) AS bin, * FROM dirty, s)
""" + union(f"""
SELECT bin, CAST(count(*) AS BIGINT) AS "rows", '{c}' AS "column", CAST(count(*) - count({c}) AS BIGINT) AS missing FROM r GROUP BY bin"""
            for c in DIRTY_COLUMNS[1:]))
def missing_by_range(spark, sf):
    return profile.missing_by_range(dirty(spark, sf), "unnamed_0")


_GAPPED = ["age", "gender", "comorbidities", "length_of_stay", "medication_adherence", "number_of_previous_admissions", "risk_category"]


@query("nullity_correlation", sql=DIRTY + union(f"""
SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr(CAST({a} IS NULL AS INT), CAST({b} IS NULL AS INT)), 6) AS r FROM dirty"""
    for a, b in __import__("itertools").combinations(_GAPPED, 2)))
def nullity_correlation(spark, sf):
    return rounded(profile.nullity_correlation(dirty(spark, sf)), "r")


@query("identifier_uniqueness", sql=DIRTY + """
SELECT CAST(count(*) AS BIGINT) AS "rows", CAST(count(DISTINCT unnamed_0) AS BIGINT) AS distinct_ids,
       count(*) = count(DISTINCT unnamed_0) AS is_unique FROM dirty
""")
def identifier_uniqueness(spark, sf):
    return profile.identifier_uniqueness(dirty(spark, sf), "unnamed_0")


@query("largest_values", sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3")
def largest_values(spark, sf):
    return profile.largest(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 3, "o_orderkey")


@query("smallest_values", sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 3")
def smallest_values(spark, sf):
    return profile.smallest(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 3, "o_orderkey")


@query("filter_where", sql=DIRTY + "SELECT unnamed_0, age, comorbidities FROM dirty WHERE age >= 100 AND comorbidities > 2")
def filter_where(spark, sf):
    rows = dirty(spark, sf).select("unnamed_0", "age", "comorbidities")
    return profile.filter_where(rows, F.col("age") >= 100, F.col("comorbidities") > 2)


_BYTES_BEFORE = " + ".join(
    f"8 * count({c})" if DIRTY_TYPES[c] != "string" else f"sum(strlen({c}))" for c in DIRTY_COLUMNS)
_AFTER = {c: ("string" if c in ("gender", "medication_adherence", "socioeconomic_status", "smoking_status") else 8)
          for c in DIRTY_COLUMNS[1:]} | {"risk_category": 4}
_BYTES_AFTER = " + ".join(f"{w} * count({c})" if w != "string" else f"sum(strlen({c}))" for c, w in _AFTER.items())


@query("compare_dataframes", sql=CLEANED + f""",
b AS (SELECT count(*) AS n, {_BYTES_BEFORE} AS bytes FROM dirty), a AS (SELECT count(*) AS n, {_BYTES_AFTER} AS bytes FROM cleaned),
m AS (
  SELECT 'rows' AS metric, b.n AS before, a.n AS after, '' AS detail FROM a, b
  UNION ALL SELECT 'columns', 10, 9, ''
  UNION ALL SELECT 'columns_dropped', 0, 1, 'Unnamed: 0'
  UNION ALL SELECT 'columns_added', 0, 0, ''
  UNION ALL SELECT 'columns_renamed', 0, 9, 'Age -> age, Comorbidities -> comorbidities, Gender -> gender, Length of Stay -> length_of_stay, '
    || 'Medication Adherence -> medication_adherence, Number of Previous Admissions -> number_of_previous_admissions, '
    || 'Risk_Category -> risk_category, Smoking Status -> smoking_status, Socioeconomic Status -> socioeconomic_status'
  UNION ALL SELECT 'bytes', b.bytes, a.bytes, '' FROM a, b)
SELECT metric, CAST(before AS BIGINT) AS before, CAST(after AS BIGINT) AS after, CAST(after - before AS BIGINT) AS change,
       CASE WHEN before <> 0 THEN round(abs(CAST(after - before AS DOUBLE)) * 100 / before, 2) END AS pct, detail FROM m
""")
def compare_dataframes(spark, sf):
    raw = raw_admissions(spark, sf)
    return compare.compare_dataframes(raw, admissions_plan().clean_all(raw))


# Two versions of orders: prices and priorities changed, rows gone, rows new, rows repeated.
_VERSIONS = """
WITH a AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey,
         CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority, o_orderstatus FROM orders WHERE o_orderkey % 11 <> 0),
after AS (
  SELECT * FROM a UNION ALL SELECT * FROM a WHERE o_orderkey % 5 = 0
  UNION ALL SELECT o_orderkey + 100000000, o_custkey, o_orderpriority, o_orderstatus FROM a WHERE o_orderkey % 13 = 0),
before AS (
  SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus FROM orders
  UNION ALL SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus FROM orders WHERE o_orderkey % 4 = 0)
"""


@query("row_changes", sql=_VERSIONS + """,
c AS (
  SELECT o_orderkey, o_custkey, o_orderpriority, o_orderstatus, CAST(sum(b) AS BIGINT) AS before, CAST(sum(a) AS BIGINT) AS after
  FROM (SELECT *, 1 AS b, 0 AS a FROM before UNION ALL SELECT *, 0, 1 FROM after) GROUP BY ALL)
SELECT * FROM c WHERE before <> after
""")
def row_changes(spark, sf):
    orders = table(spark, sf, "orders")
    return changes.row_changes(_version(spark, orders, "before"), _version(spark, orders, "after"))


def _version(spark, orders, name):
    return spark.sql(_VERSIONS.replace("FROM orders", "FROM {orders}") + f"SELECT * FROM {name}", orders=orders)


# A key has at most one differing row a side here, or copies of it, so pairs need no order of rows.
@query("table_changes", sql=_VERSIONS + """,
c AS (
  SELECT o_orderkey AS k, o_custkey AS x, o_orderpriority AS y, o_orderstatus AS z, sum(b) AS before, sum(a) AS after
  FROM (SELECT *, 1 AS b, 0 AS a FROM before UNION ALL SELECT *, 0, 1 FROM after) GROUP BY ALL),
l AS (SELECT *, unnest(range(1, CAST(before - after AS BIGINT) + 1)) AS pair FROM c WHERE before > after),
r AS (SELECT *, unnest(range(1, CAST(after - before AS BIGINT) + 1)) AS pair FROM c WHERE after > before),
p AS (
  SELECT coalesce(l.k, r.k) AS o_orderkey, coalesce(l.pair, r.pair) AS pair, l.k IS NULL AS new, r.k IS NULL AS gone,
         l.x AS lx, r.x AS rx, l.y AS ly, r.y AS ry, l.z AS lz, r.z AS rz
  FROM l FULL JOIN r ON l.k = r.k AND l.pair = r.pair)
SELECT o_orderkey, CASE WHEN new THEN 'added' ELSE 'removed' END AS change, pair, CAST(NULL AS VARCHAR) AS "column",
       CAST(NULL AS VARCHAR) AS before, CAST(NULL AS VARCHAR) AS after FROM p WHERE new OR gone
UNION ALL SELECT o_orderkey, 'changed', pair, 'o_custkey', CAST(lx AS VARCHAR), CAST(rx AS VARCHAR) FROM p WHERE NOT (new OR gone) AND lx IS DISTINCT FROM rx
UNION ALL SELECT o_orderkey, 'changed', pair, 'o_orderpriority', ly, ry FROM p WHERE NOT (new OR gone) AND ly IS DISTINCT FROM ry
UNION ALL SELECT o_orderkey, 'changed', pair, 'o_orderstatus', lz, rz FROM p WHERE NOT (new OR gone) AND lz IS DISTINCT FROM rz
""")
def table_changes(spark, sf):
    orders = table(spark, sf, "orders")
    return changes.table_changes(_version(spark, orders, "before"), _version(spark, orders, "after"), ["o_orderkey"])
