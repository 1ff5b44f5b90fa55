"""Cap outliers at fitted limits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.columns import col, number, numeric_columns, present, require
from tallyloom.functions.selection import exact_quantiles

METHODS = ("zscore", "iqr", "quantile", "mad", "domain")


@dataclass(frozen=True)
class OutlierClipper:
    """Limits per column:

    zscore    mean ± threshold · sample deviation
    iqr       quartiles ∓ threshold · interquartile range
    quantile  the threshold quantile, as a ceiling above 0.5 and else as a floor
    mad       median ± threshold · median absolute deviation; a column with deviation 0 stays
    domain    limits given by the caller
    """

    method: str = "zscore"
    threshold: float = 3.0
    domain_limits: Mapping[str, tuple[float, float]] | None = None

    def __post_init__(self):
        if self.method not in METHODS:
            raise ValueError(f"method must be one of {METHODS}, got {self.method!r}")

    def fit(self, df: DataFrame, columns: Sequence[str] | None = None) -> FittedClipper:
        columns = list(columns) if columns is not None else numeric_columns(df)
        require(df, *columns)
        limits = getattr(self, f"_{self.method}")(df, columns)
        return FittedClipper({c: pair for c, pair in limits.items() if pair != (None, None)})

    def fit_transform(self, df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
        return self.fit(df, columns).transform(df)

    def _zscore(self, df: DataFrame, columns: Sequence[str]) -> dict:
        cells = [F.struct(F.avg(number(c)).alias("mean"), F.stddev_samp(number(c)).alias("std")).alias(f"s{i}")
                 for i, c in enumerate(columns)]
        row = df.agg(*cells).first()
        out = {}
        for i, c in enumerate(columns):
            mean, std = row[f"s{i}"]
            out[c] = (mean - self.threshold * std, mean + self.threshold * std) if std else (None, None)
        return out

    def _iqr(self, df: DataFrame, columns: Sequence[str]) -> dict:
        quartiles = exact_quantiles(df, columns, (0.25, 0.75))
        return {
            c: (q1 - self.threshold * (q3 - q1), q3 + self.threshold * (q3 - q1)) if q1 is not None else (None, None)
            for c, (q1, q3) in quartiles.items()
        }

    def _quantile(self, df: DataFrame, columns: Sequence[str]) -> dict:
        if not 0 < self.threshold < 1:
            raise ValueError("the quantile method needs a threshold between 0 and 1")
        at = {c: q[0] for c, q in exact_quantiles(df, columns, (self.threshold,)).items()}
        return {c: (None, q) if self.threshold > 0.5 else (q, None) for c, q in at.items()}

    def _mad(self, df: DataFrame, columns: Sequence[str]) -> dict:
        medians = {c: q[0] for c, q in exact_quantiles(df, columns, (0.5,)).items() if q[0] is not None}
        away = df.select(*[F.abs(number(c) - F.lit(m)).alias(c) for c, m in medians.items()])
        deviations = {c: q[0] for c, q in exact_quantiles(away, list(medians), (0.5,)).items()}
        return {
            c: (medians[c] - self.threshold * d, medians[c] + self.threshold * d) for c, d in deviations.items() if d
        }

    def _domain(self, df: DataFrame, columns: Sequence[str]) -> dict:
        if self.domain_limits is None:
            raise ValueError("the domain method needs domain_limits")
        return {c: tuple(pair) for c, pair in self.domain_limits.items() if c in columns}


@dataclass(frozen=True)
class FittedClipper:
    limits: Mapping[str, tuple[float | None, float | None]] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.clipped(c) for c in present(df, list(self.limits))})

    def clipped(self, column: str) -> Column:
        """A missing value stays missing: greatest and least would skip it."""
        low, high = self.limits[column]
        value = number(column)
        if low is not None:
            value = F.greatest(value, F.lit(float(low)))
        if high is not None:
            value = F.least(value, F.lit(float(high)))
        return F.when(col(column).isNotNull(), value)
