"""Schema-driven column selection and small Column helpers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
FLOATING = (T.FloatType, T.DoubleType)


def col(name: str) -> Column:
    """Reference a column by its exact name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def numeric_columns(df: DataFrame, with_boolean: bool = False) -> list[str]:
    kinds = NUMERIC + ((T.BooleanType,) if with_boolean else ())
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def flat_columns(df: DataFrame) -> list[str]:
    """Columns that are neither arrays, maps nor structs."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, nested)]


def present(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def require(df: DataFrame, *names: str) -> None:
    for name in names:
        if name not in df.columns:
            raise ValueError(f"column {name!r} not found; have {df.columns}")


def nan_to_null(df: DataFrame) -> DataFrame:
    """Spark treats NaN as a large number; every operator here expects NULL for missing."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, FLOATING)]
    if not floats:
        return df
    return df.withColumns({n: F.when(~F.isnan(col(n)), col(n)) for n in floats})


def number(name: str) -> Column:
    return col(name).cast("double")


def unpivot(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), name: str = "column",
            value: str = "value", as_type: str = "double") -> DataFrame:
    """Long form (keep…, name, value) without the missing cells; one narrow pass."""
    cells = F.array(*[
        F.struct(F.lit(c).alias(name), col(c).cast(as_type).alias(value)) for c in columns
    ])
    return (
        df.select(*[col(k) for k in keep], F.explode(cells).alias("_cell"))
        .select(*[col(k) for k in keep], F.col(f"_cell.{name}").alias(name), F.col(f"_cell.{value}").alias(value))
        .filter(col(value).isNotNull())
    )


def rows_from_aggregate(one_row: DataFrame, structs: Sequence[str]) -> DataFrame:
    """Turn a one-row frame whose named columns are structs of one shape into one row per struct."""
    return one_row.select(F.inline(F.array(*[col(s) for s in structs])))


def stable_hash(keys: Sequence[str], seed: int | str) -> Column:
    """52 bits of md5(key…:seed) as a bigint: the same order in every engine, exact as a double."""
    parts = [col(k).cast("string") for k in keys] + [F.lit(str(seed))]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13), 16, 10).cast("bigint")


HASH_SPAN = float(16 ** 13)


def missing_names(df: DataFrame, columns: Sequence[str]) -> set[str]:
    """Which of the columns have at least one missing cell."""
    if not columns:
        return set()
    row = df.agg(*[F.coalesce(F.bool_or(col(c).isNull()), F.lit(False)).alias(f"c{i}") for i, c in enumerate(columns)])
    found = row.first()
    return {c for i, c in enumerate(columns) if found[f"c{i}"]}
