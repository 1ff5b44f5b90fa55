"""What the operators share: input columns under private names, written intermediate tables, hash orders."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.session import checkpointed, scratch_path

__all__ = ["byte_blocks", "checkpointed", "columns_of", "ordered", "scratch_path", "stored", "whole"]


def whole(column: str) -> Column:
    """The text, a NULL read as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def columns_of(df: DataFrame, **names: str) -> DataFrame:
    """Only the named input columns, under the operator's own names: other columns can't clash with them."""
    return df.select(*[F.col(f"`{given}`").alias(own) for own, given in names.items()])


def ordered(*parts: Column | str, seed: int = 0) -> Column:
    """A 64-bit number that puts rows in a pseudo-random order, the same in every run."""
    return F.xxhash64(*parts, F.lit(seed))


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written once to the shared folder and read again: a cut lineage, and a size that Spark knows."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def byte_blocks(sizes: Sequence[int], rows: int, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """(from, to) of blocks of up to `rows` texts and `most` bytes; a longer text is a block of its own."""
    at = held = 0
    for i, size in enumerate(sizes):
        if i > at and (i - at >= rows or held + size > most):
            yield at, i
            at, held = i, 0
        held += size
    if at < len(sizes):
        yield at, len(sizes)
