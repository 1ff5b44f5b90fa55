"""Matrices of products of many columns from one scan: partial matrices in every task, summed in two steps.

A plan holds one array of the columns, however many pairs they make. A task adds up the matrices of its batches and
sends one row for each key, as bytes; these rows are added up in `FAN` parts a key and then in one, so that neither a task
nor the driver holds the matrices of all tasks. Sums are made in the order of the partitions, so they repeat.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.columns import number

#: Parts in which the rows of one key are added up first.
FAN = 32


def cells(columns: Sequence[Column]) -> Column:
    """The columns of a row as an array, NaN for a missing cell."""
    return F.array(*[F.coalesce(c.cast("double"), F.lit(float("nan"))) for c in columns])


def rows_of(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """The rows of a batch of arrays."""
    return batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up rows that are sorted by key."""
    key, total, part = None, None, 0
    for batch in batches:
        for k, p, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
            own = np.frombuffer(data)
            if total is not None and k == key:
                total = total + own
                continue
            if total is not None:
                yield _row(key, part, total)
            key, total, part = k, own, p
    if total is not None:
        yield _row(key, part, total)


def _row(key: str, part: int, total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([key], pa.string()), pa.array([part], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["key", "part", "sums"])


def summed(df: DataFrame, columns: Sequence[Column], sums: Callable[[np.ndarray], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """Adds `sums` of all rows, which maps a block of rows to flat arrays by key; the keys reach the driver."""
    width = len(columns)
    shape = "key string, part long, sums binary"

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for key, own in sums(rows_of(batch, width)).items():
                held[key] = held[key] + own if key in held else own
        part = TaskContext.get().partitionId()
        for key, total in held.items():
            yield _row(key, part, total)

    rows = df.select(cells(columns).alias("x")).mapInArrow(partial, shape)
    parts = rows.repartition("key", F.pmod("part", F.lit(FAN))).sortWithinPartitions("key", F.pmod("part", F.lit(FAN)), "part")
    halves = parts.mapInArrow(_summed, shape)
    whole = halves.repartition("key").sortWithinPartitions("key", "part").mapInArrow(_summed, shape)
    return {r["key"]: np.frombuffer(r["sums"]) for r in whole.collect()}


@dataclass
class Gram:
    """Of columns i and j over the rows that have both: rows, sums of i, of its squares, and of products with j.

    Values are taken from `shift`, near the mean, so that large offsets do not cancel digits.
    """

    rows: float
    shift: np.ndarray
    n: np.ndarray
    sums: np.ndarray
    squares: np.ndarray
    products: np.ndarray

    def correlations(self) -> np.ndarray:
        """Pearson correlations of all pairs; NaN where one of the two is constant."""
        spread = self.n * self.squares - self.sums**2
        spread = np.where(spread > 1e-12 * self.n * self.squares, spread, 0.0)
        together = self.n * self.products - self.sums * self.sums.T
        with np.errstate(divide="ignore", invalid="ignore"):
            r = together / (np.sqrt(spread) * np.sqrt(spread.T))
        return np.where(np.isfinite(r), np.clip(r, -1.0, 1.0), np.nan)

    def centred(self) -> tuple[float, np.ndarray, np.ndarray]:
        """(rows, means, centred products) of columns without gaps."""
        sums = np.diag(self.sums)
        return self.rows, self.shift + sums / self.rows, self.products - np.outer(sums, sums) / self.rows


def pattern_free(block: np.ndarray) -> dict[str, np.ndarray]:
    """The four matrices of a block of rows, and its length, as one flat array."""
    has = ~np.isnan(block)
    x, m = np.where(has, block, 0.0), has.astype(float)
    return {"": np.concatenate([[float(len(block))], *[a.ravel() for a in (m.T @ m, x.T @ m, (x * x).T @ m, x.T @ x)]])}


def gram(df: DataFrame, columns: Sequence[Column], shift: bool = True) -> Gram:
    """The matrices of all pairs of columns: one scan, after one for the means unless `shift` is off."""
    width = len(columns)
    about = np.zeros(width)
    if shift:
        means = df.agg(*[F.avg(c.cast("double")).alias(f"m{i}") for i, c in enumerate(columns)]).first()
        about = np.array([0.0 if m is None else m for m in means], dtype=float)
    moved = [c.cast("double") - F.lit(float(a)) for c, a in zip(columns, about)]
    found = summed(df, moved, pattern_free).get("")
    if found is None:
        found = np.zeros(1 + 4 * width * width)
    n, sums, squares, products = found[1:].reshape(4, width, width)
    return Gram(float(found[0]), about, n, sums, squares, products)


def pairs(names: Sequence[str], values: np.ndarray) -> list[tuple[str, str, float | None]]:
    """(name, name, value) of all pairs, NaN as NULL."""
    return [(a, b, None if np.isnan(v) else float(v)) for a, row in zip(names, values) for b, v in zip(names, row)]


def of(names: Sequence[str]) -> list[Column]:
    return [number(n) for n in names]
