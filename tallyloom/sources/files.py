"""File readers: CSV, Parquet, JSON, ORC and Feather.  All return lazy frames with NULL for missing."""

from __future__ import annotations

import json
from collections.abc import Sequence
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tallyloom.functions.columns import col, nan_to_null

# The texts a CSV reader takes for a missing cell.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)


def ensure_exists(spark: SparkSession, path: str) -> None:
    """Raise FileNotFoundError for a missing path, on any Hadoop file system."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.globStatus(hadoop_path):
        raise FileNotFoundError(f"no such file: {path}")


def _csv_names(columns: Sequence[str]) -> list[str]:
    """Blank header cells, which Spark calls _c<i>, get the name `Unnamed: <i>`."""
    return [f"Unnamed: {i}" if c == f"_c{i}" else c for i, c in enumerate(columns)]


def _fits(value: Column, kind: str) -> Column:
    if kind == "boolean":
        return value.isin("True", "False", "TRUE", "FALSE", "true", "false")
    return value.try_cast(kind).isNotNull()


def infer_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Give text columns the narrowest of bigint, double, boolean that takes every cell.  One scan."""
    columns = list(columns if columns is not None else df.columns)
    kinds = ("bigint", "double", "boolean")
    checks = [
        F.struct(
            F.count(col(c)).alias("n"),
            *[F.count_if(col(c).isNotNull() & ~_fits(col(c), k)).alias(k) for k in kinds],
        ).alias(f"c{i}")
        for i, c in enumerate(columns)
    ]
    bad = df.agg(*checks).first()
    chosen = {
        c: next((k for k in kinds if bad[f"c{i}"]["n"] and not bad[f"c{i}"][k]), None) for i, c in enumerate(columns)
    }
    return nan_to_null(df.withColumns({c: col(c).cast(k) for c, k in chosen.items() if k}))


def load_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, infer: bool = True,
             na_tokens: Sequence[str] = NA_TOKENS, multiline: bool = False, **options) -> DataFrame:
    """Read CSV with a header.

    Cells equal to one of `na_tokens` become NULL.  Without a schema the types come from one
    pass over the text; at scale pass a schema and no extra pass is made.
    """
    ensure_exists(spark, path)
    settings = {"header": True, "escape": '"', "multiLine": multiline, "inferSchema": False, **options}
    text = spark.read.options(**settings).csv(path)
    text = text.toDF(*_csv_names(text.columns))
    text = text.withColumns({c: F.when(~col(c).isin(list(na_tokens)), col(c)) for c in text.columns})
    if schema is not None:
        fields = T.StructType.fromDDL(schema).fields if isinstance(schema, str) else schema.fields
        return nan_to_null(text.select(*[col(f.name).try_cast(f.dataType).alias(f.name) for f in fields]))
    return infer_types(text) if infer else text


def load_parquet(spark: SparkSession, path: str, **options) -> DataFrame:
    ensure_exists(spark, path)
    return nan_to_null(spark.read.options(**options).parquet(path))


def load_orc(spark: SparkSession, path: str, **options) -> DataFrame:
    ensure_exists(spark, path)
    return nan_to_null(spark.read.options(**options).orc(path))


def load_json(spark: SparkSession, path: str, orient: str = "records", schema: T.StructType | str | None = None,
              **options) -> DataFrame:
    """Read JSON.

    orient="lines"    one object per line; the splittable form for large data
    orient="records"  an array of objects per file
    orient="columns"  one object per file, {column: {row label: value}}
    The last two cannot be split inside a file; many files are still read in parallel.
    """
    ensure_exists(spark, path)
    if orient == "columns":
        return _json_columns(spark, path, schema)
    if orient not in ("lines", "records"):
        raise ValueError(f"orient must be lines, records or columns, got {orient!r}")
    reader = spark.read.options(multiLine=orient == "records", **options)
    return nan_to_null((reader.schema(schema) if schema is not None else reader).json(path))


def _json_columns(spark: SparkSession, path: str, schema: T.StructType | str | None) -> DataFrame:
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("_file"), "value")
    cells = (
        files.select("_file", F.explode(F.from_json("value", "map<string,map<string,string>>")).alias("column", "cells"))
        .select("_file", "column", F.explode("cells").alias("row", "value"))
    )
    if schema is not None:
        fields = T.StructType.fromDDL(schema).fields if isinstance(schema, str) else schema.fields
        names = [f.name for f in fields]
    else:
        fields, names = None, [r["column"] for r in cells.select("column").distinct().orderBy("column").collect()]
    wide = cells.groupBy("_file", "row").pivot("column", names).agg(F.first("value")).drop("_file", "row")
    if fields is None:
        return infer_types(wide)
    return nan_to_null(wide.select(*[col(f.name).try_cast(f.dataType).alias(f.name) for f in fields]))


#: Tasks that read the ends of Feather files.
FOOTER_TASKS = 256


class _Batches(InputPartition):
    def __init__(self, path: str, first: int, last: int):
        self.path, self.first, self.last = path, first, last


def _open_feather(path: str):
    import pyarrow as pa
    from pyarrow import fs

    filesystem, inner = fs.FileSystem.from_uri(path)
    return pa.ipc.open_file(filesystem.open_input_file(inner))


class _FeatherReader(DataSourceReader):
    def __init__(self, counts: dict[str, int], columns: list[str] | None, batches_per_task: int):
        self.counts, self.columns, self.step = counts, columns, batches_per_task

    def partitions(self):
        out = [
            _Batches(path, i, min(i + self.step, n)) for path, n in self.counts.items() for i in range(0, n, self.step)]
        return out or [_Batches("", 0, 0)]

    def read(self, partition):
        if not partition.path:
            return
        source = _open_feather(partition.path)
        for i in range(partition.first, partition.last):
            batch = source.get_batch(i)
            yield batch.select(self.columns) if self.columns else batch


class FeatherSource(DataSource):
    """Arrow IPC files, one task per run of record batches, so a large file is read by many tasks."""

    @classmethod
    def name(cls):
        return "feather"

    def _columns(self) -> list[str] | None:
        named = self.options.get("columns")
        return named.split("\n") if named else None

    def schema(self):
        found = T.StructType.fromJson(json.loads(self.options["fields"]))
        wanted = self._columns()
        return T.StructType([found[c] for c in wanted]) if wanted else found

    def reader(self, schema):
        counts = json.loads(self.options["counts"])
        return _FeatherReader(counts, self._columns(), int(self.options.get("batchesPerTask", "1")))


def _footers(spark: SparkSession, paths: list[str]) -> tuple[dict[str, int], str]:
    """Record batches of each file, and the schema of all, read from the files' ends by a Spark job."""
    def read(frames):
        import pandas as pd
        from pyspark.sql.pandas.types import from_arrow_schema

        for frame in frames:
            found = [(p, _open_feather(p)) for p in frame["path"]]
            yield pd.DataFrame(
                [(p, f.num_record_batches, from_arrow_schema(f.schema).json()) for p, f in found], columns=["path", "n", "fields"])

    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(len(paths), FOOTER_TASKS))
    rows = sorted(listed.mapInPandas(read, "path string, n long, fields string").collect())
    odd = next((r for r in rows if r["fields"] != rows[0]["fields"]), None)
    if odd is not None:
        raise ValueError(f"{odd['path']} has another schema than {rows[0]['path']}")
    return {r["path"]: r["n"] for r in rows}, rows[0]["fields"]


def load_feather(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                 batches_per_task: int = 1) -> DataFrame:
    """Read a Feather file or a folder of them (extension .feather or .arrow), which must have one schema."""
    from pyarrow import fs

    ensure_exists(spark, path)
    uri = path if urlparse(path).scheme else f"file://{path}"
    uri = uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri
    filesystem, inner = fs.FileSystem.from_uri(uri)
    info = filesystem.get_file_info(inner)
    prefix = uri[: len(uri) - len(inner)]
    if info.type == fs.FileType.Directory:
        inside = filesystem.get_file_info(fs.FileSelector(inner, recursive=True))
        files = sorted(f.path for f in inside if f.path.endswith((".feather", ".arrow")))
    else:
        files = [inner]
    if not files:
        raise FileNotFoundError(f"no Feather file below {path}")
    spark.dataSource.register(FeatherSource)
    counts, fields = _footers(spark, [prefix + f for f in files])
    reader = spark.read.format("feather").options(counts=json.dumps(counts), fields=fields)
    if columns:
        reader = reader.option("columns", "\n".join(columns))
    return nan_to_null(reader.option("batchesPerTask", str(batches_per_task)).load())
