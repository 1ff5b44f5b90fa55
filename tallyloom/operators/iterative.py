"""Round-robin imputation: each column with gaps is predicted from the others, round after round.

Rows that miss the same columns form a pattern. Whatever the rounds do, a filled cell stays an affine function of its
row's observed cells, the same for all rows of a pattern. So the sums and products of each pattern's observed cells, from
one scan, give the products of the filled columns in every round: the rounds touch no rows, and the small regularised
regressions are solved on the driver. One more scan says how far the rounds move the cells, which decides where they stop.
Tables with more patterns than the driver holds are scanned for each step instead, with the same result. A transform
replays the rounds on blocks of rows, in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.columns import col, number, require
from tallyloom.functions.gram import cells, gram, of, rows_of, summed

#: Combinations of missing columns whose moments the driver holds; beyond them every step scans the rows.
MAX_PATTERNS = 20_000

# Fixed values of the evidence maximisation.
PRIOR = 1e-6
FIT_ROUNDS = 300
FIT_TOLERANCE = 1e-3


def products(df: DataFrame, names: Sequence[str], where: Column | None = None) -> tuple[float, np.ndarray, np.ndarray]:
    """(n, means, centred product matrix) of columns without gaps.

    Products are taken about a shift near the mean, so that large offsets do not cancel digits.
    """
    found = gram(df if where is None else df.filter(where), of(names))
    if found.rows == 0:
        raise ValueError("no rows to fit on")
    return found.centred()


def bayesian_ridge(n: float, gram: np.ndarray, xy: np.ndarray, yy: float) -> np.ndarray:
    """Ridge coefficients whose noise and weight precision maximise the evidence, from centred products."""
    eigen, basis = np.linalg.eigh(gram)
    eigen = np.clip(eigen, 0.0, None)
    target = basis.T @ xy
    noise = 1.0 / (yy / n + np.finfo(float).eps)
    weight = 1.0

    def solve() -> np.ndarray:
        return basis @ (target / (eigen + weight / noise))

    previous = None
    for _ in range(FIT_ROUNDS):
        w = solve()
        loss = max(yy - 2 * w @ xy + w @ gram @ w, 0.0)
        effective = float(np.sum(noise * eigen / (weight + noise * eigen)))
        weight = (effective + 2 * PRIOR) / (float(w @ w) + 2 * PRIOR)
        noise = (n - effective + 2 * PRIOR) / (loss + 2 * PRIOR)
        if previous is not None and np.abs(previous - w).sum() < FIT_TOLERANCE:
            break
        previous = w
    return solve()


def _by_pattern(block: np.ndarray) -> dict[str, np.ndarray]:
    """{pattern: rows, sums and products of its observed cells} of a block; a pattern is a text of 0 and 1."""
    width = block.shape[1]
    has = ~np.isnan(block)
    packed = np.packbits(has, axis=1)
    kinds, which = np.unique(packed, axis=0, return_inverse=True)
    out = {}
    for k in range(len(kinds)):
        rows = block[which.ravel() == k]
        seen = has[which.ravel() == k][0]
        x = rows[:, seen]
        sums, square = np.zeros(width), np.zeros((width, width))
        sums[seen] = x.sum(axis=0)
        square[np.ix_(seen, seen)] = x.T @ x
        out["".join("1" if b else "0" for b in seen)] = np.concatenate([[float(len(rows))], sums, square.ravel()])
    return out


class _Pattern:
    """The rows that miss the same columns: their moments, and the filled columns as affine functions of the cells."""

    def __init__(self, seen: np.ndarray, n: float, sums: np.ndarray, square: np.ndarray):
        width = len(seen)
        self.seen, self.n, self.sums, self.square = seen, n, sums, square
        self.map = np.zeros((width, width))
        self.map[seen, seen] = 1.0  # gaps begin at the mean, which is 0 here
        self.add = np.zeros(width)

    def moments(self) -> tuple[float, np.ndarray, np.ndarray]:
        """(rows, sums, products) of the filled columns."""
        sums = self.map @ self.sums + self.n * self.add
        cross = np.outer(self.map @ self.sums, self.add)
        return self.n, sums, self.map @ self.square @ self.map.T + cross + cross.T + self.n * np.outer(self.add, self.add)

    def fill(self, target: int, others: Sequence[int], weights: np.ndarray, intercept: float) -> None:
        if not self.seen[target]:
            self.map[target] = weights @ self.map[others]
            self.add[target] = weights @ self.add[others] + intercept


def filled(block: np.ndarray, rounds: Sequence[Sequence[tuple[int, Sequence[float], float]]], moved: np.ndarray | None = None) -> np.ndarray:
    """A block of rows, taken from the means, with its gaps filled; `moved[r]` is raised to round r's largest change."""
    has = ~np.isnan(block)
    z = np.where(has, block, 0.0)
    rest = [[i for i in range(block.shape[1]) if i != j] for j in range(block.shape[1])]
    gaps = [np.flatnonzero(~has[:, j]) for j in range(block.shape[1])]
    for r, steps in enumerate(rounds):
        before = z.copy() if moved is not None else None
        for target, weights, intercept in steps:
            if len(gaps[target]):
                z[gaps[target], target] = z[np.ix_(gaps[target], rest[target])] @ np.asarray(weights) + intercept
        if moved is not None and len(z):
            moved[r] = max(moved[r], float(np.abs(z - before).max()))
    return z


@dataclass(frozen=True)
class IterativeImputer:
    """Start from the means; per round predict the gaps of each column, fewest gaps first.

    Stops after `max_iter` rounds or when the largest change of a round falls below `tol` times the
    largest absolute value present.
    """

    max_iter: int = 10
    tol: float = 1e-3

    def fit(self, df: DataFrame, columns: Sequence[str]) -> FittedIterativeImputer:
        """Three jobs, however many rounds: means, moments of each pattern, and how far each round moves the cells."""
        require(df, *columns)
        columns = list(columns)
        stats = df.agg(*[
            F.struct(F.avg(number(c)).alias("mean"), F.count_if(col(c).isNull()).alias("gaps"),
                     F.max(F.abs(number(c))).alias("top")).alias(f"s{i}") for i, c in enumerate(columns)
        ], F.approx_count_distinct(F.array(*[col(c).isNull() for c in columns]), 0.02).alias("patterns")).first()
        means = [stats[f"s{i}"]["mean"] for i in range(len(columns))]
        if any(m is None for m in means):
            raise ValueError(f"columns without any value: {[c for c, m in zip(columns, means) if m is None]}")
        enough = self.tol * max(stats[f"s{i}"]["top"] for i in range(len(columns)))
        if len(columns) < 2 or not self.max_iter:
            return FittedIterativeImputer(columns, means, [])
        # columns without gaps are fitted as well, for gaps in frames transformed later
        order = sorted(range(len(columns)), key=lambda i: stats[f"s{i}"]["gaps"])
        about = _about(columns, means)
        if stats["patterns"] <= MAX_PATTERNS:
            patterns = _patterns(summed(df, about, _by_pattern), len(columns))
            rounds = [self._round(patterns, order) for _ in range(self.max_iter)]
        else:
            rounds = self._rounds_by_scans(df, about, order)
        far = _moves(df, about, rounds)
        calm = [i for i, m in enumerate(far) if m < enough]
        return FittedIterativeImputer(columns, means, rounds[: calm[0] + 1] if calm else rounds)

    def _round(self, patterns: list[_Pattern], order: Sequence[int]) -> list[tuple[int, list[float], float]]:
        steps = []
        for target in order:
            held = [p.moments() for p in patterns if p.seen[target]]
            others, weights, intercept = _regression(target, sum(h[0] for h in held), sum(h[1] for h in held), sum(h[2] for h in held))
            for p in patterns:
                p.fill(target, others, weights, intercept)
            steps.append((target, weights.tolist(), intercept))
        return steps

    def _rounds_by_scans(self, df: DataFrame, about: Sequence[Column], order: Sequence[int]) -> list:
        """The rounds from one scan for each step, which replays those before it."""
        width, rounds = len(about), []
        for _ in range(self.max_iter):
            rounds.append([])
            for target in order:
                def moments(block: np.ndarray, target=target) -> dict[str, np.ndarray]:
                    z = filled(block, rounds)[~np.isnan(block[:, target])]
                    return {"": np.concatenate([[float(len(z))], z.sum(axis=0), (z.T @ z).ravel()])}

                found = summed(df, about, moments)[""]
                _, weights, intercept = _regression(target, found[0], found[1 : 1 + width], found[1 + width :].reshape(width, width))
                rounds[-1].append((target, weights.tolist(), intercept))
        return rounds

    def fit_transform(self, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        return self.fit(df, columns).transform(df)


def _regression(target: int, n: float, sums: np.ndarray, square: np.ndarray) -> tuple[list[int], np.ndarray, float]:
    """(the other columns, their weights, intercept) from the moments of the rows that have the target."""
    others = [i for i in range(len(sums)) if i != target]
    centred = square - np.outer(sums, sums) / n
    weights = bayesian_ridge(n, centred[np.ix_(others, others)], centred[others, target], float(centred[target, target]))
    return others, weights, float(sums[target] / n - weights @ (sums[others] / n))


def _about(columns: Sequence[str], means: Sequence[float]) -> list[Column]:
    return [number(c) - F.lit(float(m)) for c, m in zip(columns, means)]


def _patterns(found: dict[str, np.ndarray], width: int) -> list[_Pattern]:
    return [
        _Pattern(np.array([c == "1" for c in key]), float(v[0]), v[1 : 1 + width], v[1 + width :].reshape(width, width))
        for key, v in sorted(found.items())]


def _moves(df: DataFrame, about: Sequence[Column], rounds: Sequence) -> list[float]:
    """The largest change of any cell in each round."""
    width = len(about)

    def largest(batches):
        moved = np.zeros(len(rounds))
        for batch in batches:
            filled(rows_of(batch, width), rounds, moved)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(rounds)), pa.int32()), pa.array(moved)], ["round", "moved"])

    found = df.select(cells(about).alias("x")).mapInArrow(largest, "round int, moved double")
    return [m for _, m in sorted(found.groupBy("round").agg(F.max("moved")).collect())]


@dataclass(frozen=True)
class FittedIterativeImputer:
    """`rounds` hold for each round the steps (column, weights of the others, intercept) on values less their means."""

    columns: list[str]
    means: list[float]
    rounds: list[list[tuple[int, list[float], float]]]

    def transform(self, df: DataFrame) -> DataFrame:
        """All rounds in one pass over blocks of rows; observed cells stay as they are."""
        require(df, *self.columns)
        rounds, width = self.rounds, len(self.columns)

        @F.pandas_udf("array<double>")
        def fill(x: pd.Series) -> pd.Series:
            block = np.array(x.tolist(), dtype=float).reshape(-1, width)
            return pd.Series(list(filled(block, rounds)))

        values = fill(cells(_about(self.columns, self.means)))
        with_values = df.withColumn("_filled", values) if rounds else df.withColumn("_filled", F.array(*[F.lit(0.0)] * width))
        out = {c: F.coalesce(number(c), F.col("_filled")[i] + F.lit(float(m))) for i, (c, m) in enumerate(zip(self.columns, self.means))}
        return with_values.withColumns(out).drop("_filled").select(*[col(c) for c in df.columns])
