"""Imputers, scalers and encoders, fitted on one frame and applied to others.

All columns of a preprocessor are fitted together: one aggregate for the numbers, one quantile
selection for the medians and one long frequency table for the categories.  What was fitted is
kept as literals, so a transform is a single projection that also runs on a stream.  Ordinal codes and
sparse vectors come from a table of sorted values instead, which is joined, and imputers that look at
several columns (nearest neighbours, rounds of regressions) run before the projection.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import OneHotEncoder as SparseEncoder
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyloom.functions.columns import col, number, require, unpivot
from tallyloom.functions.dictionary import coded, dictionary, sizes
from tallyloom.functions.selection import exact_quantiles
from tallyloom.operators.iterative import IterativeImputer
from tallyloom.operators.kmodes import KModesImputer
from tallyloom.operators.neighbors import KNNImputer

#: The widest one-hot encoding with a column for each category, and with one vector (Spark ML names its places).
MAX_COLUMNS, MAX_VECTOR = 2000, 1_000_000
#: Imputers that fill all columns that name an equal one together, from each other.
JOINT = (KNNImputer, IterativeImputer)


@dataclass(frozen=True)
class Mean:
    """Fill with the mean."""


@dataclass(frozen=True)
class Median:
    """Fill with the exact median."""


@dataclass(frozen=True)
class MostFrequent:
    """Fill with the most frequent value, the smallest of equals."""


@dataclass(frozen=True)
class Constant:
    """Fill with a fixed value."""

    value: object = "missing"


@dataclass(frozen=True)
class StandardScale:
    """(x − mean) / population deviation; a constant column is only centred."""


@dataclass(frozen=True)
class MinMaxScale:
    """(x − min) / (max − min); a constant column becomes 0."""


@dataclass(frozen=True)
class NoScale:
    """Leave the imputed number as it is."""


@dataclass(frozen=True)
class OneHot:
    """One 0/1 column per category seen at fit; an unseen one gives zeros.

    With `sparse` the column becomes one vector `<name>_vec` instead, which suits columns of very many categories. More
    than `MAX_COLUMNS` categories raise, or `MAX_VECTOR` with `sparse`; ordinal codes have no such limit.
    """

    sparse: bool = False


@dataclass(frozen=True)
class Ordinal:
    """Position of the category in sorted order; an unseen one gives `unknown`."""

    unknown: float | None = None


@dataclass(frozen=True)
class Numeric:
    """What one numeric column goes through."""

    imputer: object = Mean()
    scaler: object = StandardScale()


@dataclass(frozen=True)
class Categorical:
    """What one text column goes through."""

    imputer: object = MostFrequent()
    encoder: object = OneHot()


@dataclass
class Codes:
    """Codes of a column's values from a table of them; `vector` makes them sparse vectors."""

    table: DataFrame
    place: int
    unknown: float | None
    vector: object | None = None

    def transform(self, df: DataFrame, name: str, imputed: Column) -> DataFrame:
        df = coded(df, self.table, self.place, imputed, f"_index_{name}", F.lit(self.unknown).cast("double"))
        return df if self.vector is None else self.vector.transform(df)


@dataclass
class FittedColumn:
    """A treated column: its outputs, and the codes that some of them need first."""

    name: str
    imputed: Column
    outputs: dict[str, Column] = field(default_factory=dict)
    codes: Codes | None = None


def detect_types(df: DataFrame) -> tuple[list[str], list[str]]:
    """Numeric (bigint, double) and categorical (text) columns; all others pass through."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.LongType, T.DoubleType))]
    return numeric, [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


class Preprocessor:
    """Column routing: custom treatment per column, defaults for the rest, other types pass through.

    Output order: custom numbers, default numbers, custom categories, default categories, the rest.
    `keep` names columns (keys, label, split) that are not treated whatever their type.

    Columns whose imputers are an equal `KNNImputer` or `IterativeImputer` are imputed together, each from the others; one
    that stands alone gets its mean. Nearest neighbours need `key`, a column that tells the rows apart.
    """

    def __init__(self, custom: Mapping[str, Numeric | Categorical] | None = None, numeric: Numeric = Numeric(),
                 categorical: Categorical = Categorical(), keep: Sequence[str] = (), key: str | None = None):
        self.custom, self.numeric, self.categorical, self.keep = dict(custom or {}), numeric, categorical, list(keep)
        self.key = key
        if key is not None and key not in self.keep:
            self.keep.append(key)

    def _route(self, df: DataFrame) -> tuple[dict[str, Numeric], dict[str, Categorical]]:
        numbers, texts = detect_types(df)

        def routed(names: list[str], kind: type, default):
            names = [n for n in names if n not in self.keep]
            own = {n: self.custom[n] for n in names if n in self.custom}
            for n, spec in own.items():
                if not isinstance(spec, kind):
                    raise TypeError(f"column {n!r} needs a {kind.__name__} treatment")
            return {**own, **{n: default for n in names if n not in own}}

        return routed(numbers, Numeric, self.numeric), routed(texts, Categorical, self.categorical)

    def fit(self, df: DataFrame) -> FittedPreprocessor:
        numbers, texts = self._route(df)
        fills = self._fit_joint(df, numbers)
        for fill in fills:
            df = fill.transform(df)
        stats = _column_stats(df, list(numbers), list(texts))
        fitted = _fit_numbers(df, numbers, stats) + _fit_texts(df, texts, stats)
        rest = [c for c in df.columns if c not in numbers and c not in texts]
        passed = [c for c in rest if c not in self.keep and isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType))]
        return FittedPreprocessor(fitted, rest, passed, fills)

    def _fit_joint(self, df: DataFrame, numbers: Mapping[str, Numeric]) -> list:
        """The fitted imputers that fill several columns at once, each for its columns."""
        together: dict[object, list[str]] = {}
        for name, spec in numbers.items():
            if isinstance(spec.imputer, JOINT):
                together.setdefault(spec.imputer, []).append(name)
        out = []
        for imputer, names in together.items():
            if isinstance(imputer, KNNImputer):
                if self.key is None:
                    raise ValueError(f"nearest neighbours of {names} need the preprocessor's key")
                out.append(imputer.fit(df, names, self.key))
            else:
                out.append(imputer.fit(df, names))
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        raise ValueError("not fitted: call fit and transform with what it returns")

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)


class FittedPreprocessor:
    """`rest` are the columns that pass through; those of them in `passed`, numbers and booleans, are features too."""

    def __init__(self, columns: list[FittedColumn], rest: list[str], passed: list[str], fills: Sequence = ()):
        self.columns, self.rest, self.passed, self.fills = columns, rest, passed, list(fills)

    @property
    def treated_names(self) -> list[str]:
        return [name for c in self.columns for name in c.outputs]

    @property
    def feature_names(self) -> list[str]:
        return [*self.treated_names, *self.passed]

    @property
    def output_names(self) -> list[str]:
        return [*self.treated_names, *self.rest]

    def transform(self, df: DataFrame) -> DataFrame:
        require(df, *[c.name for c in self.columns])
        for fill in self.fills:
            df = fill.transform(df)
        for c in self.columns:
            if c.codes is not None:
                df = c.codes.transform(df, c.name, c.imputed)
        outputs = [expression.alias(name) for c in self.columns for name, expression in c.outputs.items()]
        return df.select(*outputs, *[col(c) for c in self.rest if c in df.columns])


def _column_stats(df: DataFrame, numbers: Sequence[str], texts: Sequence[str]) -> dict:
    """Moments of the numbers and the gap counts of all columns, from one aggregate."""
    cells = {c: F.struct(
        F.count(F.lit(1)).alias("rows"), F.count(col(c)).alias("n"), F.avg(number(c)).alias("mean"),
        F.var_pop(number(c)).alias("var"), F.min(number(c)).alias("min"), F.max(number(c)).alias("max"),
    ) for c in numbers}
    cells |= {c: F.struct(F.count(F.lit(1)).alias("rows"), F.count(col(c)).alias("n")) for c in texts}
    if not cells:
        return {}
    row = df.agg(*[cell.alias(f"s{i}") for i, cell in enumerate(cells.values())]).first()
    return {c: row[f"s{i}"] for i, c in enumerate(cells)}


def _fit_numbers(df: DataFrame, specs: Mapping[str, Numeric], stats: Mapping) -> list[FittedColumn]:
    medians = exact_quantiles(df, [c for c, s in specs.items() if isinstance(s.imputer, Median)], (0.5,))
    modes = _modes(df, [c for c, s in specs.items() if isinstance(s.imputer, MostFrequent)])
    out = []
    for name, spec in specs.items():
        s = stats[name]
        fill = _number_fill(name, spec.imputer, s, medians, modes)
        imputed = F.coalesce(number(name), F.lit(fill).cast("double"))
        out.append(FittedColumn(name, imputed, {name: _scaled(imputed, spec.scaler, s, fill)}))
    return out


def _number_fill(name: str, imputer, s, medians: Mapping, modes: Mapping) -> float | None:
    if isinstance(imputer, (Mean, *JOINT)):
        return s["mean"]
    if isinstance(imputer, Median):
        return medians[name][0]
    if isinstance(imputer, MostFrequent):
        return None if modes[name] is None else float(modes[name])
    if isinstance(imputer, Constant):
        return float(imputer.value)
    raise TypeError(f"unknown imputer for {name!r}: {imputer!r}")


def _scaled(value: Column, scaler, s, fill: float | None) -> Column:
    """Statistics of the imputed column follow from those of the values present and the fill."""
    if isinstance(scaler, NoScale) or s["rows"] == 0 or (s["n"] == 0 and fill is None):
        return value
    present, absent, f = s["n"], s["rows"] - s["n"], 0.0 if fill is None else fill
    absent = 0 if fill is None else absent
    total = present + absent
    seen_mean, seen_var = s["mean"] or 0.0, s["var"] or 0.0
    mean = (present * seen_mean + absent * f) / total
    if isinstance(scaler, StandardScale):
        spread = present * (seen_var + (seen_mean - mean) ** 2) + absent * (f - mean) ** 2
        deviation = math.sqrt(spread / total)
        return (value - F.lit(mean)) / F.lit(deviation if deviation > 0 else 1.0)
    if isinstance(scaler, MinMaxScale):
        ends = ([s["min"], s["max"]] if present else []) + ([f] if absent else [])
        low, high = min(ends), max(ends)
        return (value - F.lit(low)) / F.lit((high - low) if high > low else 1.0)
    raise TypeError(f"unknown scaler {scaler!r}")


def _modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent value per numeric column, the smallest on ties."""
    if not columns:
        return {}
    counts = unpivot(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(F.min_by("value", F.struct((-F.col("n")).alias("n"), "value")).alias("top"))
    found = {r["column"]: r["top"] for r in best.collect()}
    return {c: found.get(c) for c in columns}


def _most_frequent(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """The most frequent text of each column, the smallest of equal ones; the maximum is taken before any shuffle."""
    if not columns:
        return {}
    counts = unpivot(df, columns, as_type="string").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("column").agg(F.min_by("value", F.struct((-F.col("n")).alias("n"), "value")).alias("top"))
    found = {r["column"]: r["top"] for r in best.collect()}
    return {c: found.get(c) for c in columns}


def _fit_texts(df: DataFrame, specs: Mapping[str, Categorical], stats: Mapping) -> list[FittedColumn]:
    tops = _most_frequent(df, [c for c, s in specs.items() if isinstance(s.imputer, MostFrequent)])
    filled = {c: _text_fill(df, c, s.imputer, tops.get(c)) for c, s in specs.items()}
    # Codes number the values after imputation; named columns are those before it, with the fill.
    wanted = {c: (col(c) if _is_named(s.encoder) else filled[c][0]) for c, s in specs.items() if s.encoder is not None}
    table = dictionary(df, wanted) if wanted else None
    widths = sizes(table) if wanted else {}
    places = {c: i for i, c in enumerate(wanted)}
    named = _named_values(table, specs, widths)
    out = []
    for name, spec in specs.items():
        imputed, fill_values = filled[name]
        if name in named:
            has_gaps = stats[name]["n"] < stats[name]["rows"]
            seen = sorted(_categories_after(spec.imputer, named[name], fill_values, has_gaps))
            out.append(FittedColumn(name, imputed, {
                f"{name}_{value}": F.coalesce((imputed == value).cast("double"), F.lit(0.0)) for value in seen
            }))
        else:
            out.append(_encoded(name, spec.encoder, imputed, table, places.get(name), widths.get(name, 0)))
    return out


def _is_named(encoder) -> bool:
    return isinstance(encoder, OneHot) and not encoder.sparse


def _named_values(table: DataFrame | None, specs: Mapping[str, Categorical], widths: Mapping[str, int]) -> dict[str, set[str]]:
    """The texts that become names of output columns; the driver has to know them, so their number is bounded."""
    named: dict[str, set[str]] = {c: set() for c, s in specs.items() if _is_named(s.encoder)}
    for c in named:
        if widths.get(c, 0) > MAX_COLUMNS:
            raise ValueError(f"column {c!r} has {widths[c]} categories, more than {MAX_COLUMNS}: use OneHot(sparse=True) or Ordinal()")
    if named and table is not None:
        for r in table.filter(F.col("column").isin(list(named))).select("column", "value").collect():
            named[r["column"]].add(r["value"])
    return named


def _categories_after(imputer, before: set[str], fill: list[str], has_gaps: bool) -> set[str]:
    """The categories of a column once it is imputed."""
    if isinstance(imputer, KModesImputer):
        has_gaps = has_gaps or imputer.placeholder in before
        before = before - {imputer.placeholder}
    return before | set(fill) if has_gaps else before


def _text_fill(df: DataFrame, name: str, imputer, top: str | None) -> tuple[Column, list[str]]:
    if isinstance(imputer, MostFrequent):
        return F.coalesce(col(name), F.lit(top).cast("string")), [top] if top is not None else []
    if isinstance(imputer, Constant):
        return F.coalesce(col(name), F.lit(str(imputer.value))), [str(imputer.value)]
    if isinstance(imputer, KModesImputer):
        model = imputer.fit(df, name)
        return model.imputed(), sorted(set(model.fill.values()))
    raise TypeError(f"unknown imputer for {name!r}: {imputer!r}")


def _encoded(name: str, encoder, imputed: Column, table: DataFrame | None, place: int | None, width: int) -> FittedColumn:
    if encoder is None:
        return FittedColumn(name, imputed, {name: imputed})
    if not isinstance(encoder, (OneHot, Ordinal)):
        raise TypeError(f"unknown encoder for {name!r}: {encoder!r}")
    index = f"_index_{name}"
    if isinstance(encoder, Ordinal):
        return FittedColumn(name, imputed, {name: col(index)}, Codes(table, place, encoder.unknown))
    if width > MAX_VECTOR:
        raise ValueError(f"column {name!r} has {width} categories, more than {MAX_VECTOR}: use Ordinal()")
    # The last place is dropped: a value that was not seen has it, and so is a vector of zeros.
    widest = table.sparkSession.createDataFrame([(float(width),)], f"`{index}` double")
    vectors = SparseEncoder(inputCol=index, outputCol=f"{name}_vec", dropLast=True).fit(widest)
    return FittedColumn(name, imputed, {f"{name}_vec": col(f"{name}_vec")}, Codes(table, place, float(width), vectors))
