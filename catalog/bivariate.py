"""Statistics of two columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import DIRTY, dirty, query, table
from tallyloom.operators import bivariate


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _signed(r):
    return f"""CASE WHEN {r} < -0.7 THEN 'very strong negative' WHEN {r} < -0.5 THEN 'strong negative'
  WHEN {r} < -0.3 THEN 'moderate negative' WHEN {r} < 0.3 THEN 'weak' WHEN {r} < 0.5 THEN 'moderate positive'
  WHEN {r} < 0.7 THEN 'strong positive' ELSE 'very strong positive' END"""


# Fixed value: the 5 % point of F(1, many), between which and the statistics of these tables there is room.
CRITICAL = 3.85


@query("pearson", sql=f"""
WITH c AS (SELECT count(*) AS n, corr(l_quantity, l_extendedprice) AS r FROM lineitem)
SELECT CAST(n AS BIGINT) AS n, round(r, 6) AS r, round(r * r * (n - 2) / (1 - r * r), 3) AS t_squared,
       CASE WHEN r * r * (n - 2) / (1 - r * r) > {CRITICAL} THEN {_signed("r")} ELSE 'not significant' END AS effect FROM c
""")
def pearson(spark, sf):
    out = bivariate.pearson(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice").drop("p_value")
    return rounded(rounded(out, "r"), "t_squared", digits=3)


@query("spearman", sql=f"""
WITH k AS (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS a,
                  rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0 AS b FROM lineitem),
c AS (SELECT count(*) AS n, corr(a, b) AS r FROM k)
SELECT CAST(n AS BIGINT) AS n, round(r, 6) AS r, round(r * r * (n - 2) / (1 - r * r), 3) AS t_squared,
       CASE WHEN r * r * (n - 2) / (1 - r * r) > {CRITICAL} THEN {_signed("r")} ELSE 'not significant' END AS effect FROM c
""")
def spearman(spark, sf):
    out = bivariate.spearman(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice").drop("p_value")
    return rounded(rounded(out, "r"), "t_squared", digits=3)


@query("regression_line", sql="""
SELECT CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n, round(regr_slope(l_extendedprice, l_quantity), 5) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 5) AS intercept, round(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem
""")
def regression_line(spark, sf):
    out = bivariate.regression_line(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    return rounded(rounded(out, "slope", "intercept", digits=5), "r2")


@query("residual_table", sql="""
WITH f AS (SELECT regr_slope(o_totalprice, o_custkey) AS s, regr_intercept(o_totalprice, o_custkey) AS i FROM orders)
SELECT o_orderkey, o_custkey, o_totalprice, round(i + s * o_custkey, 4) AS predicted, round(o_totalprice - (i + s * o_custkey), 4) AS residual
FROM orders, f
""")
def residual_table(spark, sf):
    out = bivariate.residual_table(table(spark, sf, "orders"), "o_custkey", "o_totalprice", ["o_orderkey"])
    return rounded(out, "predicted", "residual", digits=4)


@query("density_grid", sql="""
WITH s AS (SELECT min(l_quantity) AS a0, max(l_quantity) AS a1, min(l_extendedprice) AS b0, max(l_extendedprice) AS b1 FROM lineitem)
SELECT least(CAST(floor((l_quantity - a0) / (a1 - a0) * 30) AS BIGINT), 29) AS cell_a,
       least(CAST(floor((l_extendedprice - b0) / (b1 - b0) * 30) AS BIGINT), 29) AS cell_b, CAST(count(*) AS BIGINT) AS n
FROM lineitem, s GROUP BY 1, 2
""")
def density_grid(spark, sf):
    return bivariate.density_grid(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")


_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("correlation_matrix", sql="\nUNION ALL ".join(
    f"SELECT '{a}' AS column_a, '{b}' AS column_b, round({'1.0' if a == b else f'corr({a}, {b})'}, 6) AS r "
    + ("" if a == b else "FROM lineitem") for a in _MEASURES for b in _MEASURES).replace("round(1.0, 6)", "CAST(1 AS DOUBLE)"))
def correlation_matrix(spark, sf):
    return rounded(bivariate.correlation_matrix(table(spark, sf, "lineitem"), _MEASURES), "r")


@query("numeric_by_category", sql="""
SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n, round(avg(l_extendedprice), 4) AS mean, round(quantile_cont(l_extendedprice, 0.5), 4) AS median,
       round(stddev_samp(l_extendedprice), 4) AS std FROM lineitem GROUP BY 1
""")
def numeric_by_category(spark, sf):
    out = bivariate.numeric_by_category(table(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag")
    return rounded(out, "mean", "median", "std", digits=4)


@query("point_biserial", sql=DIRTY + f"""
, c AS (SELECT count(*) AS n, corr(CASE WHEN gender = 'Male' THEN 1.0 ELSE 0.0 END, age) AS r FROM dirty WHERE gender IS NOT NULL AND age IS NOT NULL)
SELECT CAST(n AS BIGINT) AS n, round(r, 6) AS r, round(r * r * (n - 2) / (1 - r * r), 4) AS t_squared,
       CASE WHEN r * r * (n - 2) / (1 - r * r) <= {CRITICAL} THEN 'not significant' WHEN abs(r) > 0.7 THEN 'very strong'
            WHEN abs(r) > 0.5 THEN 'strong' WHEN abs(r) > 0.3 THEN 'moderate' ELSE 'weak' END AS effect FROM c
""")
def point_biserial(spark, sf):
    out = bivariate.point_biserial(dirty(spark, sf), "age", "gender").drop("p_value")
    return rounded(rounded(out, "r"), "t_squared", digits=4)


@query("anova", sql=DIRTY + """
, p AS (SELECT age AS v, medication_adherence AS g FROM dirty WHERE age IS NOT NULL AND medication_adherence IS NOT NULL),
s AS (SELECT g, count(*) AS n, avg(v) AS m, var_pop(v) AS w FROM p GROUP BY g), t AS (SELECT avg(v) AS a FROM p),
c AS (SELECT count(*) AS k, sum(n) AS n, sum(n * (m - a) * (m - a)) AS b, sum(n * w) AS w FROM s, t)
SELECT CAST(n AS BIGINT) AS n, CAST(k - 1 AS BIGINT) AS df_between, CAST(n - k AS BIGINT) AS df_within, round(b, 3) AS ss_between,
       round(w, 3) AS ss_within, round((b / (k - 1)) / (w / (n - k)), 5) AS f FROM c
""")
def anova(spark, sf):
    out = bivariate.anova(dirty(spark, sf), "age", "medication_adherence").drop("p_value", "effect")
    return rounded(rounded(out, "ss_between", "ss_within", digits=3), "f", digits=5)


@query("crosstab", sql=DIRTY + """
SELECT medication_adherence, risk_category, CAST(count(*) AS BIGINT) AS n FROM dirty
WHERE medication_adherence IS NOT NULL AND risk_category IS NOT NULL GROUP BY 1, 2
""")
def crosstab(spark, sf):
    return bivariate.crosstab(dirty(spark, sf), "medication_adherence", "risk_category")


@query("crosstab_wide", sql=DIRTY + """
SELECT smoking_status, CAST(count(*) FILTER (WHERE gender = 'Female') AS BIGINT) AS "Female",
       CAST(count(*) FILTER (WHERE gender = 'Male') AS BIGINT) AS "Male"
FROM dirty WHERE smoking_status IS NOT NULL AND gender IS NOT NULL GROUP BY 1
""")
def crosstab_wide(spark, sf):
    return bivariate.crosstab_wide(dirty(spark, sf), "smoking_status", "gender")


@query("crosstab_shares", sql="""
SELECT lang, source, CAST(count(*) AS BIGINT) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY lang), 6) AS share
FROM documents GROUP BY 1, 2
""")
def crosstab_shares(spark, sf):
    return rounded(bivariate.crosstab_shares(table(spark, sf, "documents"), "lang", "source"), "share")


@query("pair_proportions", sql="""
SELECT o_orderstatus, o_orderpriority, CAST(count(*) AS BIGINT) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS proportion
FROM orders GROUP BY 1, 2
""")
def pair_proportions(spark, sf):
    return rounded(bivariate.pair_proportions(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority"), "proportion")


def _chi_square(a, b, source, where="TRUE"):
    return f"""
d AS (SELECT {a} AS a, {b} AS b FROM {source} WHERE {where} AND {a} IS NOT NULL AND {b} IS NOT NULL),
r AS (SELECT a, count(*) AS nr FROM d GROUP BY a), k AS (SELECT b, count(*) AS nc FROM d GROUP BY b),
s AS (SELECT (SELECT count(*) FROM d) AS n, (SELECT count(*) FROM r) AS nr, (SELECT count(*) FROM k) AS nk),
g AS (SELECT r.a, k.b, r.nr * k.nc / (SELECT n FROM s) AS e, (SELECT count(*) FROM d WHERE d.a = r.a AND d.b = k.b) AS o FROM r, k),
x AS (SELECT sum(CASE WHEN s.nr = 2 AND s.nk = 2 THEN (abs(o - e) - least(0.5, abs(o - e))) ^ 2 / e ELSE (o - e) ^ 2 / e END) AS chi2,
             any_value(s.n) AS n, any_value(s.nr) AS nr, any_value(s.nk) AS nk FROM g, s)
SELECT CAST(n AS BIGINT) AS n, CAST(nr AS BIGINT) AS "rows", CAST(nk AS BIGINT) AS "columns", CAST((nr - 1) * (nk - 1) AS BIGINT) AS dof,
       round(chi2, 5) AS chi2, round(sqrt(chi2 / (n * (least(nr, nk) - 1))), 6) AS cramers_v FROM x"""


@query("chi_square", sql="WITH " + _chi_square("lang", "source", "documents"))
def chi_square(spark, sf):
    out = bivariate.chi_square(table(spark, sf, "documents"), "lang", "source").drop("p_value", "effect")
    return rounded(rounded(out, "chi2", digits=5), "cramers_v")


@query("chi_square_two_by_two", sql=DIRTY + "," + _chi_square("gender", "risk_category", "dirty"))
def chi_square_two_by_two(spark, sf):
    out = bivariate.chi_square(dirty(spark, sf), "gender", "risk_category").drop("p_value", "effect")
    return rounded(rounded(out, "chi2", digits=5), "cramers_v")


@query("chi_square_with_empty_cells", sql="WITH " + _chi_square("conv_id", "turn", "conversations"))
def chi_square_with_empty_cells(spark, sf):
    """Short conversations have no late turns, so many cells are empty."""
    out = bivariate.chi_square(table(spark, sf, "conversations"), "conv_id", "turn").drop("p_value", "effect")
    return rounded(rounded(out, "chi2", digits=5), "cramers_v")


@query("bivariate_effects")
def bivariate_effects(spark, sf):
    """p-values and effect bands of every test; SQL has no tail functions."""
    rows, items = dirty(spark, sf), table(spark, sf, "lineitem")
    out = []
    for name, frame, statistic in (
        ("pearson", bivariate.pearson(items, "l_quantity", "l_extendedprice"), "r"),
        ("point_biserial", bivariate.point_biserial(rows, "age", "gender"), "r"),
        ("anova", bivariate.anova(rows, "age", "medication_adherence"), "f"),
        ("chi_square", bivariate.chi_square(rows, "medication_adherence", "risk_category"), "cramers_v"),
    ):
        out.append(frame.select(F.lit(name).alias("test"), F.col(statistic).alias("statistic"), "p_value", "effect"))
    result = out[0]
    for part in out[1:]:
        result = result.unionByName(part)
    return result


@query("analyse_pair", sql="""
SELECT 'crosstab' AS "table", count(*) AS n FROM (SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem)
UNION ALL SELECT 'by_category', count(DISTINCT l_returnflag) FROM lineitem
UNION ALL SELECT 'residuals', count(*) FROM lineitem
""")
def analyse_pair(spark, sf):
    """The tables follow the types of the two columns: groups that occur, categories, and rows."""
    rows = table(spark, sf, "lineitem").select("l_returnflag", "l_linestatus", "l_quantity", "l_extendedprice")
    texts = bivariate.analyse_pair(rows, "l_returnflag", "l_linestatus")["crosstab"]
    mixed = bivariate.analyse_pair(rows, "l_quantity", "l_returnflag")["by_category"]
    numbers = bivariate.analyse_pair(rows, "l_quantity", "l_extendedprice")["residuals"]
    parts = [("crosstab", texts), ("by_category", mixed), ("residuals", numbers)]
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n") for name, df in parts]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])
