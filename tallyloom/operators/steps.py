"""Cleaning steps as values, so that a chain of them can be run or counted in a single pass.

A step either keeps rows by a predicate, replaces columns by expressions, or reshapes the
frame.  `count_changes` carries an alive flag through the chain instead of running one job
per step: what a step dropped or changed becomes one sum in one aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.columns import col

ALIVE = "_alive"


@dataclass(frozen=True)
class KeepRows:
    """Keep the rows for which the predicate is true; `keep` sees the frame for its schema only."""

    name: str
    keep: Callable[[DataFrame], Column | None]

    def __call__(self, df: DataFrame) -> DataFrame:
        predicate = self.keep(df)
        return df if predicate is None else df.filter(predicate)


@dataclass(frozen=True)
class ReplaceColumns:
    """Set columns from expressions over the frame."""

    name: str
    updates: Callable[[DataFrame], Mapping[str, Column]]

    def __call__(self, df: DataFrame) -> DataFrame:
        updates = dict(self.updates(df))
        return df.withColumns(updates) if updates else df


@dataclass(frozen=True)
class Reshape:
    """Any other DataFrame → DataFrame function that keeps rows one to one (rename, cast, reorder, drop)."""

    name: str
    function: Callable[[DataFrame], DataFrame]

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.function(df)


@dataclass(frozen=True)
class DropRepeats:
    """A deduplication: rows meet each other, so it is counted by two row counts."""

    name: str
    function: Callable[[DataFrame], DataFrame]

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.function(df)


Step = KeepRows | ReplaceColumns | Reshape | DropRepeats | Callable[[DataFrame], DataFrame]


def run_steps(df: DataFrame, steps: Iterable[Step]) -> DataFrame:
    return reduce(lambda frame, step: frame.transform(step), steps, df)


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def count_changes(df: DataFrame, steps: Iterable[Step]) -> DataFrame:
    """(step_no, step, column, metric, value): rows dropped and values changed by every step, in one pass."""
    flags: list[tuple[int, str, str, str]] = []
    parts: list[DataFrame] = []
    frame = df.withColumn(ALIVE, F.lit(True))

    def note(step_no: int, step, column: str, metric: str) -> str:
        flags.append((step_no, getattr(step, "name", getattr(step, "__name__", "step")), column, metric))
        return f"_n{len(flags) - 1}"

    def flush() -> None:
        if flags:
            cells = [
                F.struct(F.lit(no).alias("step_no"), F.lit(name).alias("step"), F.lit(column).alias("column"),
                         F.lit(metric).alias("metric"),
                         F.coalesce(F.sum(F.col(f"_n{i}").cast("long")), F.lit(0)).alias("value")).alias(f"s{i}")
                for i, (no, name, column, metric) in enumerate(flags)
            ]
            one = frame.agg(*cells)
            parts.append(one.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(flags))]))))

    for step_no, step in enumerate(steps, start=1):
        plain = frame.drop(ALIVE, *[f"_n{i}" for i in range(len(flags))])
        if isinstance(step, KeepRows):
            predicate = step.keep(plain)
            if predicate is not None:
                held = _flag(predicate)
                mark = note(step_no, step, "", "rows_dropped")
                frame = frame.withColumns({mark: F.col(ALIVE) & ~held, ALIVE: F.col(ALIVE) & held})
        elif isinstance(step, ReplaceColumns):
            updates = dict(step.updates(plain))
            marks = {}
            for name, new in updates.items():
                old = col(name).cast("string") if name in plain.columns else F.lit(None).cast("string")
                marks[note(step_no, step, name, "values_changed")] = F.col(ALIVE) & ~old.eqNullSafe(new.cast("string"))
            frame = frame.withColumns(marks).withColumns(updates)
        elif isinstance(step, DropRepeats):
            flush()
            flags.clear()
            alive = frame.filter(F.col(ALIVE)).select(*[col(c) for c in plain.columns])
            after = step(alive)
            before_n = alive.agg(F.count(F.lit(1))).scalar()
            parts.append(after.agg(F.count(F.lit(1)).alias("_n")).select(
                F.lit(step_no).alias("step_no"), F.lit(step.name).alias("step"), F.lit("").alias("column"),
                F.lit("rows_dropped").alias("metric"), (before_n - F.col("_n")).alias("value"),
            ))
            frame = after.withColumn(ALIVE, F.lit(True))
        else:
            helpers = [ALIVE, *[f"_n{i}" for i in range(len(flags))]]
            frame = _reshape_with(frame, step, helpers)
    flush()
    if not parts:
        return df.sparkSession.createDataFrame([], "step_no int, step string, column string, metric string, value long")
    return reduce(DataFrame.unionByName, parts)


def _reshape_with(frame: DataFrame, step, helpers: list[str]) -> DataFrame:
    """Run a reshape although helper columns are present."""
    held = "tallyloomhelpers"
    carried = frame.withColumn(held, F.struct(*[F.col(h) for h in helpers])).drop(*helpers)
    moved = step(carried)
    return moved.withColumns({h: F.col(f"{held}.{h}") for h in helpers}).drop(held)
