"""Column expressions for statistics whose flavour matters."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _ratio(top: Column, bottom: Column) -> Column:
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def sample_skewness(value: Column) -> Column:
    """Bias-corrected skewness; NULL below three values, 0 for a constant."""
    n = F.count(value)
    corrected = F.skewness(value) * _ratio(F.sqrt(n * (n - 1)), n - 2)
    return F.when(n > 2, F.when(F.min(value) == F.max(value), 0.0).otherwise(corrected))


def sample_kurtosis(value: Column) -> Column:
    """Bias-corrected excess kurtosis; NULL below four values, 0 for a constant."""
    n = F.count(value)
    corrected = _ratio(n - 1, (n - 2) * (n - 3)) * ((n + 1) * F.kurtosis(value) + 6)
    return F.when(n > 3, F.when(F.min(value) == F.max(value), 0.0).otherwise(corrected))


def correlation(a: Column, b: Column) -> Column:
    """Pearson correlation over rows with both values; NULL, not an error, when one of them is constant."""
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a), F.when(both, b)
    return _ratio(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def missing(value: Column) -> Column:
    return F.count_if(value.isNull())


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(_ratio(part * 100, whole), digits)


def divide(top: Column, bottom: Column) -> Column:
    return _ratio(top, bottom)


def divide_or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(_ratio(top, bottom), F.lit(0.0))
