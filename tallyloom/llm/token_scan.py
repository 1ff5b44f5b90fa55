"""Token counts of documents by a separator scan over flat, unindexed token files.

A token file is nothing but little-endian unsigned ids of 4 bytes (or of 2, for vocabularies of up to 65,536), with the
end-of-document id after each document. Files
are cut into byte ranges; a task reads one range, compares all its ids with the separator at once, and returns where the
separators are. Documents cross the borders of ranges, so a prefix scan over the ranges of each file (within spans of
ranges, then over the spans) carries two numbers forward: how many documents have ended, and where the last one did.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.tables import checkpointed, columns_of, scratch_path, whole
from tallyloom.llm.tokens import tokenizer

#: Ids in a range that one task row reads, and ranges in a span of the prefix scan.
RANGE, SPAN = 1 << 20, 1024
_ROWS = 64


def _store(uri: str):
    from pyarrow import fs

    # Hadoop writes a local path as file:/x
    return fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file:///") else uri)


def write_token_files(
    docs: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", id_bytes: int = 4,
) -> DataFrame:
    """Writes one flat file for each partition of the documents; (file, bytes, place, id) in the order of the files.

    The folder must be one that all executors reach. A repeated attempt of a task writes a file of its own name, and
    only the files that the returned table names count. A NULL or empty text is the end id alone.
    """
    rows = columns_of(docs, id=id_col, text=text_col).select("id", whole("text").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    end, kept = np.array([end_id], dtype="<u4").tobytes(), f"<u{id_bytes}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(path, literal=True)
        if encoder.marked.get_vocab_size() > 1 << 8 * id_bytes:
            raise ValueError(f"ids of {id_bytes} bytes are too short for the vocabulary")
        name = f"{folder}/part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.bin"
        keys: list = []
        size, out = 0, None
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                data = b"".join(x + end for x in encoder.encode(part.column(1).to_pylist()))
                data = np.frombuffer(data, dtype="<u4").astype(kept, copy=False).tobytes()
                if out is None:
                    store, place = _store(name)
                    store.create_dir(place.rsplit("/", 1)[0], recursive=True)
                    out = store.open_output_stream(place)
                out.write(data)
                size += len(data)
                keys.append(part.column(0))
        if out is None:
            return
        out.close()
        place = 0
        for column in keys:
            n = len(column)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * n), pa.array([size] * n, pa.int64()), pa.array(range(place, place + n), pa.int64()), column],
                ["file", "bytes", "place", "id"])
            place += n

    return checkpointed(rows.mapInArrow(write, f"file string, bytes long, place long, id {kind}"))


def files_of(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, bytes) of token files, as Spark lists them; their content is not read."""
    return spark.read.format("binaryFile").load(paths).select(F.col("path").alias("file"), F.col("length").alias("bytes"))


def _ranges(files: DataFrame, size: int, id_bytes: int) -> DataFrame:
    ids = F.floor(F.col("bytes") / id_bytes)
    last = F.ceil(ids / size) - 1
    cut = files.filter(ids > 0).select("file", ids.cast("long").alias("ids"), F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("range"))
    return cut.repartition(F.col("file"), F.col("range"))


def separators(files: DataFrame, end_id: int, size: int = RANGE, id_bytes: int = 4) -> DataFrame:
    """(file, ids, range, ends): the places of the separators in each range of `size` ids of (file, bytes)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, ids, number in zip(*[c.to_pylist() for c in batch.columns]):
                store, place = _store(name)
                with store.open_input_file(place) as source:
                    source.seek(id_bytes * number * size)
                    found = np.frombuffer(source.read(id_bytes * min(size, ids - number * size)), dtype=f"<u{id_bytes}")
                ends = np.flatnonzero(found == end_id) + number * size
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([ids]), pa.array([number]), pa.array([ends], pa.list_(pa.int64()))],
                    ["file", "ids", "range", "ends"])

    return _ranges(files, size, id_bytes).mapInArrow(scan, "file string, ids long, range long, ends array<long>")


def _carried(ranges: DataFrame, span: int) -> DataFrame:
    """With (ended, last): separators before each range of a file, and the place of the last of them (-1: none)."""
    own = ranges.select(
        "file", "range", F.size("ends").alias("n"), F.try_element_at("ends", F.lit(-1)).alias("end"),
        F.floor(F.col("range") / span).alias("span"))

    def before(w) -> tuple[Column, Column]:
        w = w.rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(w), F.lit(0)), F.coalesce(F.max("end").over(w), F.lit(-1))

    n, end = before(Window.partitionBy("file", "span").orderBy("range"))
    inner = own.withColumns({"n0": n, "end0": end})
    spans = own.groupBy("file", "span").agg(F.sum("n").alias("n"), F.max("end").alias("end"))
    n, end = before(Window.partitionBy("file").orderBy("span"))
    spans = spans.withColumns({"n1": n, "end1": end}).drop("n", "end")
    return inner.join(spans, ["file", "span"]).select(
        "file", "range", (F.col("n0") + F.col("n1")).alias("ended"), F.greatest("end0", "end1").alias("last"))


def document_lengths(files: DataFrame, end_id: int, size: int = RANGE, span: int = SPAN, id_bytes: int = 4) -> DataFrame:
    """(file, place, start, n_tokens, closed) of every document of (file, bytes).

    place counts the documents of a file from 0, start is the document's first id, n_tokens leaves the separator out. Ids
    after the last separator are a document that is not closed. Empty files have no documents; bytes after the last
    whole id are ignored.
    """
    found = checkpointed(separators(files, end_id, size, id_bytes))
    carried = found.join(_carried(found, span), ["file", "range"])
    previous = F.concat(F.array("last"), F.col("ends"))
    each = carried.select("file", "ended", F.posexplode(F.arrays_zip(F.col("ends").alias("end"), F.slice(previous, F.lit(1), F.size("ends")).alias("previous"))).alias("k", "x"))
    closed = each.select(
        "file", (F.col("ended") + F.col("k")).alias("place"), (F.col("x.previous") + 1).alias("start"),
        (F.col("x.end") - F.col("x.previous") - 1).alias("n_tokens"), F.lit(True).alias("closed"))
    totals = found.groupBy("file").agg(F.max("ids").alias("ids"), F.sum(F.size("ends")).alias("n"), F.max(F.try_element_at("ends", F.lit(-1))).alias("end"))
    start = F.coalesce("end", F.lit(-1)) + 1
    rest = totals.filter(F.col("ids") > start).select(
        "file", F.col("n").cast("long").alias("place"), start.alias("start"), (F.col("ids") - start).alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.unionByName(rest)


def token_counts(
    docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", size: int = RANGE,
    id_bytes: int = 4,
) -> DataFrame:
    """(id, n_tokens) of each document, counted in token files that are written for it.

    Ids may be NULL or repeated: each row is a document. A NULL or empty text has no tokens. Special tokens that a text
    spells out are ordinary text. An empty table gives no rows; further columns are ignored.
    """
    written = write_token_files(docs, scratch_path(docs.sparkSession, "tokens"), path, end_id, id_col, text_col, id_bytes)
    files = written.select("file", "bytes").distinct()
    lengths = document_lengths(files, end_id, size, id_bytes=id_bytes)
    return written.join(lengths, ["file", "place"]).select(F.col("id").alias(id_col), "n_tokens")
