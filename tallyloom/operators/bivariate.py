"""Statistics of two columns: correlation, regression, group comparison and association.

Rows with a missing cell in either column are left out.  A test is one aggregate over the pairs; its
single result row comes to the driver for the p-value and goes back as a one-row frame.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from tallyloom.functions.columns import col, number, require
from tallyloom.functions.gram import gram, of, pairs
from tallyloom.functions.running import average_ranks, quantiles_by
from tallyloom.functions.stats import correlation, divide
from tallyloom.functions.tails import chi2_p_value, f_p_value

# Significance level and the lower edges of the effect bands.
ALPHA = 0.05
CORRELATION_BANDS = ((0.7, "very strong"), (0.5, "strong"), (0.3, "moderate"))
ANOVA_BANDS = ((10.0, "very strong"), (5.0, "strong"), (2.0, "moderate"))
ASSOCIATION_BANDS = ((0.5, "very strong"), (0.3, "strong"), (0.1, "moderate"))


def _pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    require(df, a, b)
    return df.select(col(a), col(b)).dropna()


def _band(size: float, bands) -> str:
    return next((name for edge, name in bands if size > edge), "weak")


def _signed_band(r: float) -> str:
    """Bands are closed on the positive side and open on the negative side."""
    for edge, name in CORRELATION_BANDS:
        if r >= edge:
            return f"{name} positive"
        if r < -edge:
            return f"{name} negative"
    return "weak"


def _finished(one: DataFrame, p_value: Callable[[Row], float | None], band: Callable[[Row], str]) -> DataFrame:
    """The row of a test with its p-value and, if significant, its effect band."""
    row = one.first()
    p = p_value(row)
    effect = "not significant" if p is None or not p < ALPHA else band(row)
    schema = T.StructType([*one.schema.fields, T.StructField("p_value", T.DoubleType()), T.StructField("effect", T.StringType())])
    return one.sparkSession.createDataFrame([(*row, p, effect)], schema)


def _r_test(one: DataFrame, band: Callable[[float], str]) -> DataFrame:
    """Test a row holding n and r: t² follows F(1, n − 2)."""
    freedom = F.col("n") - 2
    t2 = F.when(F.abs("r") >= 1.0, F.lit(float("inf"))).otherwise(
        divide(F.col("r") * F.col("r") * freedom, 1 - F.col("r") * F.col("r")))
    return _finished(
        one.withColumn("t_squared", t2), lambda row: f_p_value(row["t_squared"], 1, row["n"] - 2), lambda row: band(row["r"]))


def pearson(df: DataFrame, a: str, b: str) -> DataFrame:
    one = _pairs(df, a, b).agg(F.count(F.lit(1)).alias("n"), correlation(number(a), number(b)).alias("r"))
    return _r_test(one, _signed_band)


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """Correlation of average ranks.

    Rows collapse to distinct pairs with a weight before any join.  The rank tables hold one row
    per value, so a frequent value meets one row there and adaptive execution may split it.
    """
    pairs = _pairs(df, a, b).groupBy(number(a).alias("_a"), number(b).alias("_b")).agg(F.count(F.lit(1)).alias("_w"))
    rows = _pairs(df, a, b).select(number(a).alias("_a"), number(b).alias("_b"))
    rank_a = average_ranks(rows, "_a").select(F.col("_a").alias("_va"), F.col("avg_rank").alias("_ra"))
    rank_b = average_ranks(rows, "_b").select(F.col("_b").alias("_vb"), F.col("avg_rank").alias("_rb"))
    ranked = pairs.join(rank_a, F.col("_a") == F.col("_va")).join(rank_b, F.col("_b") == F.col("_vb"))
    # all ranks average to (n + 1) / 2; centring keeps the sums small
    total = pairs.agg(F.sum("_w")).scalar()
    centred = ranked.withColumn("_mid", (total + 1) / F.lit(2.0)).withColumns(
        {"_da": F.col("_ra") - F.col("_mid"), "_db": F.col("_rb") - F.col("_mid")})
    w = F.col("_w")
    one = centred.agg(
        F.sum(w).alias("n"), F.sum(w * F.col("_da") * F.col("_db")).alias("_ab"),
        F.sum(w * F.col("_da") * F.col("_da")).alias("_aa"), F.sum(w * F.col("_db") * F.col("_db")).alias("_bb"),
    ).select("n", divide(F.col("_ab"), F.sqrt("_aa") * F.sqrt("_bb")).alias("r"))
    return _r_test(one, _signed_band)


def regression_line(df: DataFrame, a: str, b: str) -> DataFrame:
    """Least-squares line of b on a."""
    y, x = number(b), number(a)
    return _pairs(df, a, b).agg(
        F.regr_count(y, x).alias("n"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
    )


def residual_table(df: DataFrame, a: str, b: str, keys: Sequence[str] = ()) -> DataFrame:
    """Predicted value and residual per row.  The fitted line is a scalar subquery, not a join."""
    rows = df.select(*[col(k) for k in keys], col(a), col(b)).filter(col(a).isNotNull() & col(b).isNotNull())
    line = _pairs(df, a, b).agg(
        F.struct(F.regr_slope(number(b), number(a)).alias("slope"),
                 F.regr_intercept(number(b), number(a)).alias("intercept")).alias("line")
    ).scalar()
    predicted = F.col("_line.intercept") + F.col("_line.slope") * number(a)
    return rows.withColumn("_line", line).withColumn("predicted", predicted).withColumn(
        "residual", number(b) - F.col("predicted")).drop("_line")


def density_grid(df: DataFrame, a: str, b: str, cells: int = 30) -> DataFrame:
    """Row counts on an equal-width grid over both columns; empty cells are left out."""
    pairs = _pairs(df, a, b)
    span = pairs.agg(F.struct(
        F.min(number(a)).alias("a0"), F.max(number(a)).alias("a1"), F.min(number(b)).alias("b0"),
        F.max(number(b)).alias("b1"),
    ).alias("s")).scalar()

    def place(name: str, low: str, high: str) -> Column:
        at = divide(number(name) - F.col(f"_s.{low}"), F.col(f"_s.{high}") - F.col(f"_s.{low}"))
        return F.least(F.floor(F.coalesce(at, F.lit(0.0)) * cells), F.lit(cells - 1).cast("long"))

    return pairs.withColumn("_s", span).groupBy(
        place(a, "a0", "a1").alias("cell_a"), place(b, "b0", "b1").alias("cell_b")
    ).agg(F.count(F.lit(1)).alias("n"))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All pairwise Pearson correlations over the rows that have both values, both triangles and the diagonal, long form.

    The sums of all pairs come from one scan as matrices, so hundreds of columns are no longer a plan than two.
    """
    require(df, *columns)
    r = gram(df, of(columns)).correlations()
    np.fill_diagonal(r, 1.0)
    return df.sparkSession.createDataFrame(pairs(columns, r), "column_a string, column_b string, r double")


def numeric_by_category(df: DataFrame, num: str, cat: str) -> DataFrame:
    """Rows, mean, median and std (n−1) per category."""
    pairs = _pairs(df, num, cat)
    stats = pairs.groupBy(col(cat)).agg(
        F.count(F.lit(1)).alias("n"), F.avg(number(num)).alias("mean"), F.stddev_samp(number(num)).alias("std"))
    medians = quantiles_by(pairs, num, (0.5,), [cat]).select(col(cat).alias("_cat"), F.col("q")[0].alias("median"))
    return stats.join(medians, col(cat) == F.col("_cat")).select(col(cat), "n", "mean", "median", "std")


def point_biserial(df: DataFrame, num: str, cat: str) -> DataFrame:
    """Correlation of a number with a two-valued category, coded 0/1 in sorted order."""
    pairs = _pairs(df, num, cat)
    top = pairs.agg(F.max(col(cat))).scalar()
    coded = pairs.withColumn("_code", (col(cat) == top).cast("double"))
    one = coded.agg(F.count(F.lit(1)).alias("n"), correlation(F.col("_code"), number(num)).alias("r"))
    return _r_test(one, lambda r: _band(abs(r), CORRELATION_BANDS))


def anova(df: DataFrame, num: str, cat: str) -> DataFrame:
    """One-way analysis of variance from per-category counts, means and inner sums of squares."""
    groups = _pairs(df, num, cat).groupBy(col(cat)).agg(
        F.count(F.lit(1)).alias("_n"), F.avg(number(num)).alias("_m"), F.var_pop(number(num)).alias("_v"))
    grand = groups.agg(F.sum(F.col("_n") * F.col("_m")) / F.sum("_n")).scalar()
    away = F.col("_m") - F.col("_grand")
    one = groups.withColumn("_grand", grand).agg(
        F.count(F.lit(1)).alias("groups"), F.sum("_n").alias("n"),
        F.sum(F.col("_n") * away * away).alias("ss_between"), F.sum(F.col("_n") * F.col("_v")).alias("ss_within"),
    )
    between, within = F.col("groups") - 1, F.col("n") - F.col("groups")
    f = divide(divide(F.col("ss_between"), between), divide(F.col("ss_within"), within))
    tested = one.select(
        "n", between.alias("df_between"), within.alias("df_within"), "ss_between", "ss_within", f.alias("f"))
    return _finished(
        tested, lambda row: f_p_value(row["f"], row["df_between"], row["df_within"]), lambda row: _band(row["f"], ANOVA_BANDS))


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts per pair of categories, long form; pairs that do not occur are left out."""
    return _pairs(df, a, b).groupBy(col(a), col(b)).agg(F.count(F.lit(1)).alias("n"))


def crosstab_wide(df: DataFrame, a: str, b: str, values: Sequence | None = None) -> DataFrame:
    """Counts with one column per category of b, zeros included."""
    grouped = _pairs(df, a, b).groupBy(col(a))
    wide = (grouped.pivot(b, list(values)) if values is not None else grouped.pivot(b)).agg(F.count(F.lit(1)))
    return wide.na.fill(0)


def crosstab_shares(df: DataFrame, a: str, b: str) -> DataFrame:
    """Share of each category of b inside its category of a."""
    counts = crosstab(df, a, b)
    rows = counts.groupBy(col(a).alias("_a")).agg(F.sum("n").alias("_row"))
    return counts.join(rows, col(a) == F.col("_a")).select(col(a), col(b), "n", divide(F.col("n"), F.col("_row")).alias("share"))


def pair_proportions(df: DataFrame, a: str, b: str) -> DataFrame:
    counts = crosstab(df, a, b)
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("_n", total).select(col(a), col(b), "n", divide(F.col("n"), F.col("_n")).alias("proportion"))


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """Test of independence and Cramér's V, with Yates' correction for one degree of freedom.

    Cells that do not occur are never formed: each would add its expectation, and those sum to n less
    the expectations of the cells that do occur.  The corrected form applies only to two by two
    tables, where the gap is the same in all four cells and the margins give the rest.
    """
    counts = crosstab(df, a, b)
    left = counts.groupBy(col(a).alias("_a")).agg(F.sum("n").alias("_row"))
    right = counts.groupBy(col(b).alias("_b")).agg(F.sum("n").alias("_column"))
    cells = counts.join(left, col(a) == F.col("_a")).join(right, col(b) == F.col("_b"))
    sizes = F.struct(
        F.sum("n").alias("n"), F.countDistinct(col(a)).alias("rows"), F.countDistinct(col(b)).alias("columns"))
    expected = F.col("_row") * F.col("_column") / F.col("_s.n")
    sized = cells.withColumn("_s", counts.agg(sizes.alias("s")).scalar()).withColumn("_e", expected)
    gap = F.abs(F.col("n") - F.col("_e"))
    corrected = gap - F.least(F.lit(0.5), gap)
    one = sized.agg(
        F.min("_s.n").alias("n"), F.min("_s.rows").alias("rows"), F.min("_s.columns").alias("columns"),
        F.count(F.lit(1)).alias("_seen"), F.sum(gap * gap / F.col("_e")).alias("_plain"), F.sum("_e").alias("_covered"),
        F.max(corrected * corrected).alias("_gap2"),
        F.max(F.struct("_row", "_column")).alias("_corner"),
    )
    n = F.col("n").cast("double")
    r1, c1 = F.col("_corner._row").cast("double"), F.col("_corner._column").cast("double")
    # Σ 1/e over the four cells
    inverse_sum = divide(n * n * n, r1 * (n - r1) * c1 * (n - c1))
    dof = (F.col("rows") - 1) * (F.col("columns") - 1)
    unseen = F.when(F.col("_seen") < F.col("rows") * F.col("columns"), n - F.col("_covered")).otherwise(0.0)
    statistic = (
        F.when(F.col("dof") == 0, 0.0).when(F.col("dof") == 1, F.col("_gap2") * inverse_sum)
        .otherwise(F.col("_plain") + unseen)
    )
    smaller = F.least(F.col("rows"), F.col("columns")) - 1
    tested = (
        one.withColumn("dof", dof).withColumn("chi2", statistic)
        .withColumn("cramers_v", F.sqrt(divide(F.col("chi2"), n * smaller)))
        .select("n", "rows", "columns", "dof", "chi2", "cramers_v")
    )
    return _finished(
        tested, lambda row: chi2_p_value(row["chi2"], row["dof"]), lambda row: _band(row["cramers_v"], ASSOCIATION_BANDS))


def is_categorical(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def analyse_pair(df: DataFrame, a: str, b: str) -> dict[str, DataFrame]:
    """The bivariate tables of two columns, chosen by their types."""
    require(df, a, b)
    kinds = is_categorical(df, a), is_categorical(df, b)
    if kinds == (False, False):
        return {
            "pearson": pearson(df, a, b), "spearman": spearman(df, a, b), "line": regression_line(df, a, b),
            "residuals": residual_table(df, a, b), "density": density_grid(df, a, b),
            "correlation": correlation_matrix(df, [a, b]),
        }
    if kinds == (True, True):
        return {
            "crosstab": crosstab(df, a, b), "shares": crosstab_shares(df, a, b), "chi_square": chi_square(df, a, b),
            "proportions": pair_proportions(df, a, b),
        }
    num, cat = (b, a) if kinds[0] else (a, b)
    categories = df.select(col(num), col(cat)).dropna().select(col(cat)).distinct().limit(3).count()
    test = point_biserial if categories == 2 else anova
    return {"by_category": numeric_by_category(df, num, cat), test.__name__: test(df, num, cat)}
