"""Row cleaning: duplicates, missing values, ranges, value maps and text fixes.

Each operator exists as a function on a frame and, where it changes rows or cells, as a step
factory in `tallyloom.operators.steps` form (`*_step`) for plans that report their changes.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import chain
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyloom.functions.columns import NUMERIC, col, present, require, type_of
from tallyloom.operators.steps import DropRepeats, KeepRows, ReplaceColumns

log = logging.getLogger(__name__)

MAP_LIMIT = 1000


# duplicates ---------------------------------------------------------------------------------------------------------

def drop_duplicate_rows(df: DataFrame, subset: Sequence[str] | None = None, order_by: str | None = None) -> DataFrame:
    """One row per key; with `order_by` the row with the smallest value of it, else any.

    The first row is a partial aggregate, not a window: each task keeps one row per key before
    the shuffle, so a key that fills a third of the table moves a handful of rows.
    """
    keys = list(subset) if subset else None
    if keys is None or order_by is None:
        return df.dropDuplicates(keys) if keys else df.dropDuplicates()
    require(df, *keys, order_by)
    others = [c for c in df.columns if c not in keys and c != order_by]
    ordered = F.struct(col(order_by).alias("_order"), *[col(c) for c in others])
    first = df.groupBy(*[col(k) for k in keys]).agg(F.min(ordered).alias("_first"))
    picked = {order_by: F.col("_first._order"), **{c: F.col("_first")[c] for c in others}}
    return first.select(*[(col(c) if c in keys else picked[c].alias(c)) for c in df.columns])


def drop_duplicate_ids(df: DataFrame, id_column: str, order_by: str | None = None) -> DataFrame:
    require(df, id_column)
    return drop_duplicate_rows(df, [id_column], order_by)


def list_duplicates(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Every row of every key that occurs more than once.

    A semi join against the repeated keys; adaptive execution splits the left side of a hot key.
    """
    keys = list(subset) if subset else df.columns
    repeated = (
        df.groupBy(*[col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
        .agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    )
    match = reduce(and_, [col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    return df.join(repeated, match, "left_semi")


def drop_duplicates_step(subset: Sequence[str] | None = None, order_by: str | None = None) -> DropRepeats:
    return DropRepeats("drop_duplicate_rows", lambda df: drop_duplicate_rows(df, subset, order_by))


# missing values -----------------------------------------------------------------------------------------------------

def drop_missing_step(columns: Sequence[str] | None = None, how: str = "any") -> KeepRows:
    def keep(df: DataFrame) -> Column | None:
        wanted = present(df, columns) if columns else df.columns
        if not wanted:
            return None
        return reduce(and_ if how == "any" else or_, [col(c).isNotNull() for c in wanted])

    return KeepRows("drop_missing_values", keep)


def drop_missing_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a missing cell in the listed columns that exist, or in any column without a list."""
    return drop_missing_step(columns)(df)


def remove_missing_values(df: DataFrame, how: str = "any", subset: Sequence[str] | None = None,
                          placeholders: Mapping[str, Sequence] | None = None) -> DataFrame:
    """Turn placeholders into NULL, then drop rows where any or all of the subset is missing."""
    if how not in ("any", "all"):
        raise ValueError(f"how must be 'any' or 'all', got {how!r}")
    if subset:
        require(df, *subset)
    nulled = {c: F.when(~col(c).isin(list(v)), col(c)) for c, v in (placeholders or {}).items() if c in df.columns}
    return drop_missing_step(subset, how)(df.withColumns(nulled) if nulled else df)


def mark_missing_step(numerical_columns: Sequence[str] = (), categorical_columns: Sequence[str] = (),
                      numerical_placeholder: float = -1, categorical_placeholder: str = "missing") -> ReplaceColumns:
    def updates(df: DataFrame) -> dict[str, Column]:
        numbers = {
            c: F.coalesce(col(c), F.lit(numerical_placeholder).cast(type_of(df, c)))
            for c in present(df, numerical_columns)
        }
        texts = {c: F.coalesce(col(c), F.lit(categorical_placeholder)) for c in present(df, categorical_columns)}
        return {**numbers, **texts}

    return ReplaceColumns("mark_missing_values", updates)


def mark_missing_values(df: DataFrame, numerical_columns: Sequence[str] = (), categorical_columns: Sequence[str] = (),
                        numerical_placeholder: float = -1, categorical_placeholder: str = "missing") -> DataFrame:
    return mark_missing_step(numerical_columns, categorical_columns, numerical_placeholder, categorical_placeholder)(df)


# numbers ------------------------------------------------------------------------------------------------------------

def out_of_range_step(column: str, min_value: float | None = None, max_value: float | None = None) -> KeepRows:
    def keep(df: DataFrame) -> Column | None:
        require(df, column)
        bounds = []
        if min_value is not None:
            bounds.append(col(column) >= min_value)
        if max_value is not None:
            bounds.append(col(column) <= max_value)
        return col(column).isNull() | reduce(and_, bounds) if bounds else None

    return KeepRows("remove_out_of_range", keep)


def remove_out_of_range(df: DataFrame, column: str, min_value: float | None = None,
                        max_value: float | None = None) -> DataFrame:
    """Drop rows outside the inclusive range; a missing value is not out of range."""
    return out_of_range_step(column, min_value, max_value)(df)


def absolute_step(columns: Sequence[str]) -> ReplaceColumns:
    def updates(df: DataFrame) -> dict[str, Column]:
        return {c: F.abs(col(c)) for c in present(df, columns) if isinstance(type_of(df, c), NUMERIC)}

    return ReplaceColumns("get_absolute_values", updates)


def get_absolute_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Absolute values of the numeric columns among those listed."""
    return absolute_step(columns)(df)


# categories and text ------------------------------------------------------------------------------------------------

def _mapped(df: DataFrame, column: str, mapping: Mapping, default) -> Column:
    pairs = chain.from_iterable((F.lit(k).cast(type_of(df, column)), F.lit(v)) for k, v in mapping.items())
    values = list(mapping.values()) + ([default] if default is not None else [])
    texts = all(isinstance(v, str) for v in values)
    new = F.try_element_at(F.create_map(*pairs), col(column))
    return _with_rest(df, column, new, "string" if texts else _value_type(mapping), default)


def _with_rest(df: DataFrame, column: str, new: Column, kind: str, default) -> Column:
    """Mapped values, and for what is not mapped the default or the old value, in the type of the map's values."""
    if default is not None:
        return F.coalesce(new, F.lit(default).cast("string") if kind == "string" else F.lit(default))
    if kind != "string" and isinstance(type_of(df, column), T.StringType):
        # labels became numbers: what was not mapped stays only if it is a number itself
        return F.coalesce(new, col(column).try_cast(kind))
    return F.coalesce(new, col(column).cast("string") if kind == "string" else col(column))


def _value_type(mapping: Mapping) -> str:
    if all(isinstance(v, bool) for v in mapping.values()):
        return "boolean"
    return "int" if all(isinstance(v, int) for v in mapping.values()) else "double"


def map_values_step(mapping_dict: Mapping[str, Mapping], new_col: str | None = None, default=None) -> ReplaceColumns:
    def updates(df: DataFrame) -> dict[str, Column]:
        out = {}
        for column, mapping in mapping_dict.items():
            if column in df.columns and mapping:
                out[new_col or column] = _mapped(df, column, mapping, default)
        return out

    return ReplaceColumns("map_values", updates)


def map_values(df: DataFrame, mapping_dict: Mapping[str, Mapping], new_col: str | None = None,
               default=None) -> DataFrame:
    """Replace values by a map; what is not in it becomes the default, or stays without one.

    Maps up to MAP_LIMIT entries become a literal map inside the projection, larger ones a join; both give the same
    rows and types. A text column whose labels map to numbers becomes numeric; labels without a number are NULL.
    """
    chosen = {c: m for c, m in mapping_dict.items() if m and c in df.columns}
    large = {c: m for c, m in chosen.items() if len(m) > MAP_LIMIT}
    if not large:
        return map_values_step(chosen, new_col, default)(df)
    out = df
    for column, mapping in chosen.items():  # with `new_col`, the last column's values stay, as in one projection
        if column not in large:
            out = map_values_step({column: mapping}, new_col, default)(out)
            continue
        texts = all(isinstance(v, str) for v in [*mapping.values(), *([default] if default is not None else [])])
        kind = "string" if texts else _value_type(mapping)
        schema = T.StructType([T.StructField("_from", type_of(df, column)), T.StructField("_to", T.StringType())])
        rows = [(_as_type(k, type_of(df, column)), _as_text(v)) for k, v in mapping.items()]
        table = df.sparkSession.createDataFrame(rows, schema).withColumn("_to", F.col("_to").cast(kind))
        out = map_from_table(out, column, table, "_from", "_to", new_col, default)
    return out


def _as_type(value, kind: T.DataType):
    if value is None or isinstance(kind, T.StringType):
        return None if value is None else _as_text(value)
    return float(value) if isinstance(kind, (T.DoubleType, T.FloatType)) else value


def _as_text(value) -> str | None:
    if value is None or isinstance(value, str):
        return value
    return str(value).lower() if isinstance(value, bool) else str(value)


def map_from_table(df: DataFrame, column: str, mapping: DataFrame, from_col: str, to_col: str,
                   new_col: str | None = None, default=None) -> DataFrame:
    """Value map held in a table, by the rules of `map_values`; `from_col` must be unique, and raises if it is not.

    No join hint: Spark broadcasts the table when its size allows. The check runs with the job, not before it.
    """
    require(df, column)
    one = F.when(F.count(F.lit(1)) == 1, F.first(col(to_col))).otherwise(
        F.raise_error(F.concat(F.lit("mapped twice: "), col(from_col).cast("string"))).cast(type_of(mapping, to_col)))
    table = mapping.groupBy(col(from_col).alias("_from")).agg(one.alias("_to"))
    kind = "string" if isinstance(type_of(mapping, to_col), T.StringType) else type_of(mapping, to_col).simpleString()
    joined = df.join(table, col(column) == F.col("_from"), "left")
    return joined.withColumn(new_col or column, _with_rest(df, column, F.col("_to"), kind, default)).drop("_from", "_to")


def unmapped_values(df: DataFrame, column: str, mapping: Mapping) -> DataFrame:
    """Distinct values of a column that a map does not cover, compared in the column's type."""
    require(df, column)
    kind = type_of(df, column)
    rows = [(_as_type(k, kind),) for k in mapping if k is not None]
    known = df.sparkSession.createDataFrame(rows, T.StructType([T.StructField("_known", kind)]))
    values = df.select(col(column)).filter(col(column).isNotNull()).distinct()
    return values.join(known, col(column) == F.col("_known"), "left_anti")


def _text_only(df: DataFrame, columns: Sequence[str]) -> list[str]:
    chosen = [c for c in present(df, columns) if isinstance(type_of(df, c), T.StringType)]
    for c in columns:
        if c not in chosen:
            log.warning("column %r is absent or not text, skipped", c)
    return chosen


def lowercase_step(columns: Sequence[str]) -> ReplaceColumns:
    return ReplaceColumns("convert_text_to_lowercase", lambda df: {c: F.lower(col(c)) for c in _text_only(df, columns)})


def convert_text_to_lowercase(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return lowercase_step(columns)(df)


def replace_character_step(to_replace: str, replacement: str, columns: Sequence[str]) -> ReplaceColumns:
    def updates(df: DataFrame) -> dict[str, Column]:
        return {c: F.replace(col(c), F.lit(to_replace), F.lit(replacement)) for c in _text_only(df, columns)}

    return ReplaceColumns("replace_character", updates)


def replace_character(df: DataFrame, to_replace: str, replacement: str, columns: Sequence[str]) -> DataFrame:
    """Replace a literal substring in text columns."""
    return replace_character_step(to_replace, replacement, columns)(df)
