"""Column names, types, order and selection.  Only strict casts look at the data."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyloom.functions.columns import col, nan_to_null, present, require
from tallyloom.functions.naming import snake_case

log = logging.getLogger(__name__)

# Type names a caller may use for strict casts.
STRICT_TYPES = {
    int: "bigint", float: "double", str: "string", bool: "boolean",
    "int": "bigint", "int64": "bigint", "int32": "int", "float": "double", "float64": "double", "float32": "float",
    "str": "string", "bool": "boolean",
}

# Which Spark types a source type name selects.
SOURCE_TYPES = {
    "object": (T.StringType,), "string": (T.StringType,), "category": (T.StringType,),
    "int": (T.LongType,), "int64": (T.LongType,), "int32": (T.IntegerType,),
    "float": (T.DoubleType,), "float64": (T.DoubleType,), "float32": (T.FloatType,),
    "number": (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType),
    "bool": (T.BooleanType,), "datetime": (T.TimestampType, T.TimestampNTZType, T.DateType),
}


def convert_column_names_to_snake_case(df: DataFrame) -> DataFrame:
    names = [snake_case(c) for c in df.columns]
    clashes = sorted({n for n in names if names.count(n) > 1 or not n})
    if clashes:
        raise ValueError(f"column names clash or vanish after conversion: {clashes}")
    return df.toDF(*names)


def _coerced(df: DataFrame, name: str, kind: str) -> Column:
    source = df.schema[name].dataType
    if kind == "numeric":
        return col(name) if isinstance(source, T.NumericType) else col(name).try_cast("double")
    if kind == "datetime":
        return F.try_to_timestamp(col(name)) if isinstance(source, T.StringType) else col(name).try_cast("timestamp")
    return col(name).cast("string") if kind == "string" else col(name)


def convert_columns_dtype(df: DataFrame, columns_types: Mapping[str, object], verify: bool = True) -> DataFrame:
    """Convert columns: numeric/datetime turn bad cells into NULL, string/category always work.

    Any other type is strict: a column with a cell that does not fit stays as it was.  All strict
    columns share one check over the data; with `verify=False` there is no check, bad cells raise.
    """
    changes: dict[str, Column] = {}
    strict: dict[str, object] = {}
    for name, kind in columns_types.items():
        if name not in df.columns:
            log.warning("column %r not found, skipped", name)
        elif kind in ("numeric", "category", "string", "datetime"):
            changes[name] = _coerced(df, name, kind)
        else:
            strict[name] = kind if isinstance(kind, T.DataType) else STRICT_TYPES.get(kind, kind)
    if strict and verify:
        bad = df.agg(*[
            F.count_if(col(n).isNotNull() & col(n).try_cast(t).isNull()).alias(f"c{i}")
            for i, (n, t) in enumerate(strict.items())
        ]).first()
        for i, name in enumerate(list(strict)):
            if bad[f"c{i}"]:
                log.warning("column %r has %d cells that do not fit, left as it was", name, bad[f"c{i}"])
                del strict[name]
    changes.update({n: col(n).cast(t) for n, t in strict.items()})
    return nan_to_null(df.withColumns(changes)) if changes else df


def convert_columns_by_dtype(df: DataFrame, source_dtype: str | T.DataType, target_dtype: object,
                             verify: bool = True) -> DataFrame:
    kinds = SOURCE_TYPES.get(source_dtype, ()) if isinstance(source_dtype, str) else (type(source_dtype),)
    chosen = [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)] if kinds else []
    if not chosen:
        log.warning("no column of type %r", source_dtype)
        return df
    return convert_columns_dtype(df, {c: target_dtype for c in chosen}, verify)


def move_column_before(df: DataFrame, col_to_move: str, before_col: str) -> DataFrame:
    require(df, col_to_move, before_col)
    if col_to_move == before_col:
        return df
    order: list[str] = []
    for name in df.columns:
        if name == before_col:
            order.append(col_to_move)
        if name != col_to_move:
            order.append(name)
    return df.select(*[col(c) for c in order])


def drop_irrelevant_features(df: DataFrame, columns_to_drop: Sequence[str]) -> DataFrame:
    return df.drop(*present(df, columns_to_drop))
