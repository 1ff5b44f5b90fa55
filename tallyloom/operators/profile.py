"""Univariate exploration: inspection, description, outliers, frequencies, missingness and the profile.

Scalars of all requested columns come from one aggregate.  Exact quantiles come from
`exact_quantiles`, whose rounds move only sketches and counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations
from operator import and_
from statistics import NormalDist

import numpy as np
from pyspark.sql import Column, DataFrame, Row, functions as F, types as T

from tallyloom.functions.columns import (
    col, flat_columns, number, numeric_columns, require, rows_from_aggregate, stable_hash, text_columns, unpivot,
)
from tallyloom.functions.gram import gram
from tallyloom.functions.running import quantiles_by
from tallyloom.functions.selection import exact_quantiles
from tallyloom.functions.stats import divide, missing, percent, sample_kurtosis, sample_skewness

QUARTILES = (0.25, 0.5, 0.75)

# Default limits of the univariate checks.
SKEW_LIMIT = 1.0
KURTOSIS_LIMIT = 3.0
KURTOSIS_LIMIT_FOR_RULE = 2.0
FENCE = 1.5
Z_LIMIT = 3.0
CARDINALITY_LIMIT = 25
RARE_SHARE = 0.01
HISTOGRAM_BINS = 30


# inspection ---------------------------------------------------------------------------------------------------------

def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("long"))


def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(col(key).asc()).limit(n)


def tail(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return df.orderBy(col(key).desc()).limit(n)


def info(df: DataFrame) -> DataFrame:
    """(position, column, type, non_null) for every column."""
    cells = [
        F.struct(F.lit(i).cast("long").alias("position"), F.lit(f.name).alias("column"),
                 F.lit(f.dataType.simpleString()).alias("type"), F.count(col(f.name)).alias("non_null")).alias(f"s{i}")
        for i, f in enumerate(df.schema.fields)
    ]
    return rows_from_aggregate(df.agg(*cells), [f"s{i}" for i in range(len(cells))])


def sample_rows(df: DataFrame, keys: Sequence[str], n: int = 5, seed: int = 42) -> DataFrame:
    """A repeatable sample: the n rows with the smallest key hash, a top-n and no full sort."""
    return df.orderBy(stable_hash(keys, seed), *[col(k) for k in keys]).limit(n)


def largest(df: DataFrame, column: str, n: int, tie: str) -> DataFrame:
    return df.filter(col(column).isNotNull()).orderBy(col(column).desc(), col(tie).asc()).limit(n)


def smallest(df: DataFrame, column: str, n: int, tie: str) -> DataFrame:
    return df.filter(col(column).isNotNull()).orderBy(col(column).asc(), col(tie).asc()).limit(n)


def sample_missing(df: DataFrame, column: str, key: str, n: int = 5) -> DataFrame:
    return df.filter(col(column).isNull()).orderBy(col(key).asc()).limit(n)


def identifier_uniqueness(df: DataFrame, id_column: str) -> DataFrame | None:
    """Rows against distinct identifiers, or None when the table has no such column."""
    if id_column not in df.columns:
        return None
    return df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(col(id_column)).alias("distinct_ids")).withColumn(
        "is_unique", F.col("rows") == F.col("distinct_ids")
    )


# numbers ------------------------------------------------------------------------------------------------------------

def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per numeric column: count, mean, std (n−1), min, quartiles, max."""
    columns = list(columns or numeric_columns(df))
    quartiles = exact_quantiles(df, columns, QUARTILES)
    cells = [
        F.struct(
            F.lit(c).alias("column"), F.count(col(c)).alias("count"), F.avg(number(c)).alias("mean"),
            F.stddev_samp(number(c)).alias("std"), F.min(number(c)).alias("min"),
            *[F.lit(q).cast("double").alias(n) for q, n in zip(quartiles[c], ("q25", "q50", "q75"))],
            F.max(number(c)).alias("max"),
        ).alias(f"s{i}")
        for i, c in enumerate(columns)
    ]
    return rows_from_aggregate(df.agg(*cells), [f"s{i}" for i in range(len(columns))])


def distinct_counts(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Number of distinct values present per column."""
    columns = list(columns or flat_columns(df))
    count = (lambda c: F.approx_count_distinct(col(c))) if approximate else (lambda c: F.countDistinct(col(c)))
    cells = [F.struct(F.lit(c).alias("column"), count(c).alias("distinct")).alias(f"s{i}") for i, c in enumerate(columns)]
    return rows_from_aggregate(df.agg(*cells), [f"s{i}" for i in range(len(columns))])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(col(column)).filter(col(column).isNotNull()).distinct()


def shape_statistics(df: DataFrame, columns: Sequence[str], skew_thresh: float = SKEW_LIMIT,
                     kurt_thresh: float = KURTOSIS_LIMIT) -> DataFrame:
    """Bias-corrected skewness and excess kurtosis per column, with flags."""
    cells = [
        F.struct(F.lit(c).alias("column"), sample_skewness(number(c)).alias("skewness"),
                 sample_kurtosis(number(c)).alias("kurtosis")).alias(f"s{i}")
        for i, c in enumerate(columns)
    ]
    rows = rows_from_aggregate(df.agg(*cells), [f"s{i}" for i in range(len(columns))])
    return rows.withColumns({
        "skewed": F.abs("skewness") > skew_thresh, "heavy_tailed": F.col("kurtosis") > kurt_thresh,
    })


def _moments(df: DataFrame, column: str) -> Row:
    v = number(column)
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count(v).alias("n"), F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"), F.stddev_pop(v).alias("pop_std"), F.min(v).alias("min"), F.max(v).alias("max"),
        sample_skewness(v).alias("skewness"), sample_kurtosis(v).alias("kurtosis"),
    ).first()


def iqr_fences(df: DataFrame, column: str, factor: float = FENCE) -> tuple[float, float]:
    low, high = exact_quantiles(df, [column], (0.25, 0.75))[column]
    if low is None:
        raise ValueError(f"column {column!r} has no values")
    return low - factor * (high - low), high + factor * (high - low)


def iqr_outliers(df: DataFrame, column: str, factor: float = FENCE) -> DataFrame:
    low, high = iqr_fences(df, column, factor)
    return df.filter((col(column) < low) | (col(column) > high))


def iqr_inliers(df: DataFrame, column: str, factor: float = FENCE) -> DataFrame:
    """Rows strictly inside the fences."""
    low, high = iqr_fences(df, column, factor)
    return df.filter((col(column) > low) & (col(column) < high))


def zscore_outliers(df: DataFrame, column: str, limit: float = Z_LIMIT) -> DataFrame:
    """Rows whose distance from the mean exceeds `limit` population standard deviations."""
    m = _moments(df, column)
    return df.filter(F.abs(number(column) - m["mean"]) > limit * F.lit(m["pop_std"]))


def outlier_report(df: DataFrame, column: str, skew_thresh: float = SKEW_LIMIT) -> DataFrame:
    """Rule chosen by the shape of the column, bounds shown, and outliers found.

    The z-score rule tests with the population deviation and shows bounds from the sample deviation.
    """
    m = _moments(df, column)
    skewed = m["skewness"] is not None and abs(m["skewness"]) > skew_thresh
    heavy = m["kurtosis"] is not None and abs(m["kurtosis"]) > KURTOSIS_LIMIT_FOR_RULE
    if skewed or heavy:
        method = "iqr"
        low, high = iqr_fences(df, column)
        outside = (col(column) < low) | (col(column) > high)
    else:
        method = "zscore"
        low, high = m["mean"] - Z_LIMIT * (m["std"] or 0.0), m["mean"] + Z_LIMIT * (m["std"] or 0.0)
        outside = F.abs(number(column) - m["mean"]) > Z_LIMIT * F.lit(m["pop_std"])
    found = df.agg(F.count_if(outside).alias("outliers"), F.count(F.lit(1)).alias("rows"))
    return found.select(
        F.lit(column).alias("column"), F.lit(method).alias("method"), F.lit(float(low)).alias("lower"),
        F.lit(float(high)).alias("upper"), "outliers", percent(F.col("outliers"), F.col("rows")).alias("pct_rows"),
    )


def histogram(df: DataFrame, column: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width counts, all bins present, the last one closed on the right."""
    span = df.agg(F.min(number(column)).alias("low"), F.max(number(column)).alias("high")).first()
    if span["low"] is None:
        raise ValueError(f"column {column!r} has no values")
    low, high = span["low"], span["high"]
    if low == high:
        low, high = low - 0.5, high + 0.5
    width = (high - low) / bins
    place = F.least(F.floor((number(column) - low) / F.lit(high - low) * bins), F.lit(bins - 1))
    counts = df.filter(col(column).isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return grid.join(counts, "bin", "left").select(
        "bin", (F.lit(low) + F.col("bin") * width).alias("lower"), (F.lit(low) + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_statistics(df: DataFrame, column: str, by: str | None = None) -> DataFrame:
    """Quartiles, whiskers at the last value inside the fences, and the number of values outside."""
    if by is None:
        low, mid, high = exact_quantiles(df, [column], QUARTILES)[column]
        if low is None:
            raise ValueError(f"column {column!r} has no values")
        rows = df.select(number(column).alias("_v"), F.array(*[F.lit(q) for q in (low, mid, high)]).alias("q"))
        keys: list[Column] = []
    else:
        quartiles = quantiles_by(df.filter(col(by).isNotNull()), column, QUARTILES, [by])
        counted = df.filter(col(by).isNotNull()).select(col(by), number(column).alias("_v"))
        rows = counted.join(quartiles.withColumnRenamed(by, "_by"), col(by) == F.col("_by")).drop("_by")
        keys = [col(by)]
    rows = rows.filter(F.col("_v").isNotNull())
    q = [F.col("q")[i] for i in range(3)]
    reach = FENCE * (q[2] - q[0])
    inside = F.col("_v").between(q[0] - reach, q[2] + reach)
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), *[F.min(x).alias(n) for x, n in zip(q, ("q25", "q50", "q75"))],
        F.min(F.when(inside, F.col("_v"))).alias("whisker_low"), F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def qq_table(df: DataFrame, column: str, points: int = 99) -> DataFrame:
    """Sample quantiles against standard normal quantiles, and the line mean + std·z."""
    probs = [i / (points + 1) for i in range(1, points + 1)]
    quantiles = exact_quantiles(df, [column], probs)[column]
    rows = [(p, NormalDist().inv_cdf(p), q) for p, q in zip(probs, quantiles)]
    table = df.sparkSession.createDataFrame(rows, "p double, theoretical double, sample double")
    m = _moments(df, column)
    return table.withColumn("line", F.lit(m["mean"]) + F.lit(m["std"]) * F.col("theoretical"))


# categories ---------------------------------------------------------------------------------------------------------

def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.filter(col(column).isNotNull()).groupBy(col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def frequency_table(df: DataFrame, column: str) -> DataFrame:
    """Count, percentage and share per category, most frequent first."""
    counts = value_counts(df, column)
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("_total", total).select(
        "value", "n", percent(F.col("n"), F.col("_total")).alias("pct"), divide(F.col("n"), F.col("_total")).alias("share"),
    ).orderBy(F.desc("n"), "value")


def category_flags(df: DataFrame, column: str, high_card_threshold: int = CARDINALITY_LIMIT,
                   rare_threshold: float = RARE_SHARE) -> DataFrame:
    """Quality flags of a text column from its frequency table."""
    counts = value_counts(df, column)
    total = counts.agg(F.sum("n")).scalar()
    value = F.col("value").cast("string")
    one = counts.withColumn("_total", total).agg(
        F.count(F.lit(1)).alias("distinct"),
        F.count_if(F.col("n") / F.col("_total") < rare_threshold).alias("rare_categories"),
        F.coalesce(F.bool_or(value.rlike(r"(?U)^\s|\s$")), F.lit(False)).alias("has_blanks"),
        F.countDistinct(F.lower(value)).alias("_folded"),
    )
    return one.select(
        F.lit(column).alias("column"), "distinct", (F.col("distinct") == 1).alias("is_constant"),
        (F.col("distinct") > high_card_threshold).alias("is_high_cardinality"), "rare_categories", "has_blanks",
        (F.col("_folded") < F.col("distinct")).alias("mixed_case"),
    )


def top_categories(df: DataFrame, column: str, n: int = 5, others: str = "Others") -> DataFrame:
    """The n most frequent categories and one row for the rest, if there is a rest."""
    counts = value_counts(df, column).withColumn("value", F.col("value").cast("string"))
    top = counts.orderBy(F.desc("n"), "value").limit(n)
    rest = counts.agg(F.sum("n").alias("_all")).select(
        F.lit(others).alias("value"), (F.col("_all") - top.agg(F.sum("n")).scalar()).alias("n")
    ).filter("n > 0")
    return top.unionByName(rest)


# missing values -----------------------------------------------------------------------------------------------------

def missing_summary(df: DataFrame) -> DataFrame:
    """Missing cells per column; the percentage is a text with two decimals, `-` for none."""
    cells = [
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                 missing(col(f.name)).alias("missing"), F.count(F.lit(1)).alias("_rows")).alias(f"s{i}")
        for i, f in enumerate(df.schema.fields)
    ]
    rows = rows_from_aggregate(df.agg(*cells), [f"s{i}" for i in range(len(cells))])
    share = F.format_string("%.2f", percent(F.col("missing"), F.col("_rows")))
    return rows.select("column", "type", "missing", F.when(F.col("missing") > 0, share).otherwise("-").alias("pct"))


def missing_matrix(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """1 where a cell is missing, else 0; the keys stay as they are."""
    rest = [c for c in df.columns if c not in keys]
    return df.select(*[col(k) for k in keys], *[col(c).isNull().cast("int").alias(c) for c in rest])


def missing_by_range(df: DataFrame, key: str, bins: int = 50) -> DataFrame:
    """Missing cells per column along equal ranges of an ordering key: the matrix at a readable size."""
    span = df.agg(F.min(number(key)).alias("low"), F.max(number(key)).alias("high")).first()
    width = (span["high"] - span["low"]) or 1.0
    place = F.least(F.floor((number(key) - span["low"]) / F.lit(width) * bins), F.lit(bins - 1))
    rest = [c for c in df.columns if c != key]
    wide = df.groupBy(place.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"), *[missing(col(c)).alias(f"m{i}") for i, c in enumerate(rest)]
    )
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("missing")) for i, c in enumerate(rest)]
    return wide.select("bin", "rows", F.inline(F.array(*cells)))


def nullity_correlation(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of the missing indicators of all column pairs.

    Rows that have both columns are counted for all pairs in one scan, from which the correlation of two indicators
    follows. Pairs with a column that is never or always missing are left out.
    """
    columns = list(columns or df.columns)
    counts = gram(df, [F.when(col(c).isNotNull(), 1.0) for c in columns], shift=False)
    n, gaps = counts.rows, counts.rows - np.diag(counts.n)
    both = n - np.diag(counts.n)[:, None] - np.diag(counts.n)[None, :] + counts.n
    spread = np.sqrt(gaps * (n - gaps))
    with np.errstate(divide="ignore", invalid="ignore"):
        r = (n * both - np.outer(gaps, gaps)) / np.outer(spread, spread)
    rows = [(columns[i], columns[j], float(r[i, j])) for i, j in combinations(range(len(columns)), 2) if np.isfinite(r[i, j])]
    return df.sparkSession.createDataFrame(rows, "column_a string, column_b string, r double")


# profile ------------------------------------------------------------------------------------------------------------

def profile(df: DataFrame, approximate_distinct: bool = False) -> DataFrame:
    """One row per column: type, missing, distinct, and for numbers the moments and quartiles.

    All columns share one aggregate; distinct and most frequent texts come from one long frequency table.
    """
    columns = flat_columns(df)
    numbers, texts = numeric_columns(df), text_columns(df)
    quartiles = exact_quantiles(df, numbers, QUARTILES)
    none = F.lit(None).cast("double")
    count = F.approx_count_distinct if approximate_distinct else F.countDistinct
    cells = []
    for i, c in enumerate(columns):
        v = number(c) if c in numbers else none
        stats = {
            "mean": F.avg(v), "std": F.stddev_samp(v), "min": F.min(v), "max": F.max(v),
            "skewness": sample_skewness(v), "kurtosis": sample_kurtosis(v), "zeros": F.count_if(v == 0),
        } if c in numbers else dict.fromkeys(("mean", "std", "min", "max", "skewness", "kurtosis"), none) | {
            "zeros": F.lit(0).cast("long")}
        for q, name in zip(quartiles.get(c, [None] * 3), ("q25", "q50", "q75")):
            stats[name] = F.lit(q).cast("double")
        cells.append(F.struct(
            F.lit(c).alias("column"), F.lit(df.schema[c].dataType.simpleString()).alias("type"),
            F.count(F.lit(1)).alias("rows"), missing(col(c)).alias("missing"),
            (F.lit(None).cast("long") if c in texts else count(col(c))).alias("distinct"),
            *[e.alias(n) for n, e in stats.items()],
        ).alias(f"s{i}"))
    rows = rows_from_aggregate(df.agg(*cells), [f"s{i}" for i in range(len(columns))])
    rows = rows.withColumn("pct_missing", percent(F.col("missing"), F.col("rows")))
    if not texts:
        return rows.withColumns({"top": F.lit(None).cast("string"), "top_count": F.lit(None).cast("long")})
    frequent = most_frequent(df, texts).select(F.col("column").alias("_c"), "top", "top_count", "values")
    joined = rows.join(F.broadcast(frequent), F.col("column") == F.col("_c"), "left")
    is_text = F.col("column").isin(texts)
    return joined.withColumn(
        "distinct", F.when(is_text, F.coalesce("values", F.lit(0))).otherwise(F.col("distinct"))).drop("_c", "values")


def most_frequent(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per text column its most frequent value (the smallest on ties), its count and the number of values.

    One row per column at most, so it is safe to broadcast.
    """
    counts = unpivot(df, columns, as_type="string").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("column").agg(
        F.min_by("value", F.struct((-F.col("n")).alias("n"), F.col("value"))).alias("top"),
        F.max("n").alias("top_count"), F.count(F.lit(1)).alias("values"),
    )


def analyse_column(df: DataFrame, feature: str) -> dict[str, DataFrame]:
    """The univariate tables of one column, chosen by its type."""
    require(df, feature)
    if isinstance(df.schema[feature].dataType, (T.NumericType, T.BooleanType)):
        typed = df.withColumn(feature, number(feature))
        return {
            "describe": describe(typed, [feature]), "distinct": distinct_counts(typed, [feature]),
            "shape": shape_statistics(typed, [feature]), "outliers": outlier_report(typed, feature),
            "histogram": histogram(typed, feature), "box": box_statistics(typed, feature),
            "qq": qq_table(typed, feature), "missing": missing_summary(df.select(col(feature))),
        }
    if isinstance(df.schema[feature].dataType, T.StringType):
        return {
            "distinct": distinct_counts(df, [feature]), "frequency": frequency_table(df, feature),
            "flags": category_flags(df, feature), "top": top_categories(df, feature),
            "missing": missing_summary(df.select(col(feature))),
        }
    raise ValueError(f"{feature!r} is neither numeric nor text: {df.schema[feature].dataType.simpleString()}")


def filter_where(df: DataFrame, *conditions: Column) -> DataFrame:
    """Rows meeting all conditions."""
    return df.filter(reduce(and_, conditions)) if conditions else df
