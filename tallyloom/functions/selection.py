"""Exact order statistics by repeated narrowing, for statistics that end up as literals.

Every round is one column-pruned scan that moves only sketches or counts.  Around each wanted rank
there is a bracket of values; brackets of a group are merged into disjoint intervals, so a row
belongs to one interval or to one of the gaps between them.  A round shrinks the intervals a
hundredfold or more, until what is inside is small enough to bring to the driver; an interval between two
heavy values, which a sketch can't split, gives up its ends and goes on inside.  The counts of
the gaps prove that a rank lies where it was looked for, whatever the sketch promised.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tallyloom.functions.columns import col, unpivot

ACCURACY = 10_000
GRID = 512
KEEP_ROWS = 200_000
MAX_GROUPS = 20_000
UNROLLED = 16


class TooManyGroups(ValueError):
    """The groups do not fit on the driver."""


@dataclass
class _Target:
    """A wanted rank of a group, the bracket it should lie in, and about how many rows that holds."""

    rank: int
    low: float
    high: float
    rows: float
    answer: float | None = None


@dataclass
class _Group:
    size: int
    low: float
    high: float
    targets: list[_Target]

    def open(self) -> list[_Target]:
        return [t for t in self.targets if t.answer is None]

    def intervals(self) -> list[tuple[float, float]]:
        """Disjoint, ascending intervals that cover the brackets of the open targets."""
        merged: list[list[float]] = []
        for t in sorted(self.open(), key=lambda t: (t.low, t.high)):
            if merged and t.low <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], t.high)
            else:
                merged.append([t.low, t.high])
        return [tuple(m) for m in merged]


def _placed(long: DataFrame, by: Sequence[str], groups: dict[tuple, _Group]) -> DataFrame:
    """Rows of groups with open targets, with `_i`, the first interval not below the row, and `_in`."""
    spans = {key: g.intervals() for key, g in groups.items() if g.open()}
    value_type = T.ArrayType(long.schema["_v"].dataType)
    if by:
        schema = T.StructType([T.StructField(f"_g{i}", long.schema[b].dataType) for i, b in enumerate(by)] + [
            T.StructField("_lows", value_type), T.StructField("_highs", value_type)])
        rows = [(*key, [low for low, _ in s], [high for _, high in s]) for key, s in spans.items()]
        # at most MAX_GROUPS rows of a few values each
        table = F.broadcast(long.sparkSession.createDataFrame(rows, schema))
        match = col(by[0]).eqNullSafe(F.col("_g0"))
        for i, b in enumerate(by[1:], start=1):
            match = match & col(b).eqNullSafe(F.col(f"_g{i}"))
        rows = long.join(table, match)
    else:
        (only,) = spans.values()
        rows = long.withColumns({
            "_lows": F.array(*[F.lit(low) for low, _ in only]).cast(value_type),
            "_highs": F.array(*[F.lit(high) for _, high in only]).cast(value_type),
        })
    most = max(len(s) for s in spans.values())
    place: Column
    if most <= UNROLLED:
        place = F.lit(0)
        for i in range(most):
            place = place + F.coalesce((F.get("_highs", F.lit(i)) < F.col("_v")).cast("int"), F.lit(0))
    else:
        place = F.size(F.filter("_highs", lambda h: h < F.col("_v")))
    rows = rows.withColumn("_i", place)
    return rows.withColumn("_in", F.coalesce(F.get("_lows", F.col("_i")) <= F.col("_v"), F.lit(False)))


def select_ranks(long: DataFrame, value: str, by: Sequence[str], wanted: Callable[[tuple, int], Sequence[int]],
                 near: Sequence[float], keep_rows: int = KEEP_ROWS) -> dict[tuple, tuple[int, dict[int, float]]]:
    """Per group: its row count and the values at the wanted zero-based ranks.

    `near` holds the approximate quantiles the ranks will fall on; a rank far from all of them is
    still found, with more rounds.  `by` must have few groups.
    """
    by = list(by)
    long = long.select(*[col(b) for b in by], col(value).alias("_v")).filter("_v IS NOT NULL")
    groups = _first_round(long, by, wanted, near)
    while True:
        still = [g for g in groups.values() if g.open()]
        if not still:
            break
        targets = [t for g in still for t in g.open()]
        if any(t.rows > keep_rows / len(targets) and t.low < t.high for t in targets):
            _narrow(long, by, groups)
        else:
            _finish(long, by, groups)
    return {key: (g.size, {t.rank: t.answer for t in g.targets}) for key, g in groups.items()}


def _first_round(long: DataFrame, by: list[str], wanted, near: Sequence[float]) -> dict[tuple, _Group]:
    slack = 2.0 / ACCURACY
    probs = sorted({min(max(p + s, 0.0), 1.0) for p in near for s in (-slack, slack)}) or [0.5]
    rows = (
        long.groupBy(*[col(b) for b in by])
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
             F.percentile_approx("_v", probs, ACCURACY).alias("_q"))
        .limit(MAX_GROUPS + 1).collect()
    )
    if len(rows) > MAX_GROUPS:
        raise TooManyGroups(f"more than {MAX_GROUPS} groups; use grouped_quantiles, which keeps them in Spark")
    groups = {}
    for row in rows:
        n = row["_n"]
        if n == 0:
            continue
        key = tuple(row[b] for b in by)
        group = _Group(n, row["_min"], row["_max"], [])
        for rank in sorted(set(wanted(key, n))):
            at = rank / max(n - 1, 1)
            below = [(p, q) for p, q in zip(probs, row["_q"]) if 0.0 < p <= at - slack / 2]
            above = [(p, q) for p, q in zip(probs, row["_q"]) if 1.0 > p >= at + slack / 2]
            p0, low = below[-1] if below else (0.0, group.low)
            p1, high = above[0] if above else (1.0, group.high)
            group.targets.append(_Target(rank, low, high, n * (p1 - p0 + 2 * slack)))
        groups[key] = group
    return groups


def _collect(counted: DataFrame, by: list[str]) -> dict[tuple, dict[int, list]]:
    """Collected rows by group and interval number."""
    out: dict[tuple, dict[int, list]] = {}
    for r in counted.collect():
        out.setdefault(tuple(r[b] for b in by), {}).setdefault(r["_i"], []).append(r)
    return out


def _narrow(long: DataFrame, by: list[str], groups: dict[tuple, _Group]) -> None:
    """Replace each bracket by the part of its interval around the rank."""
    grid = [i / GRID for i in range(1, GRID)]
    edge = 2.0 / ACCURACY
    inside = F.when(F.col("_in"), F.col("_v"))
    low, high = F.get("_lows", F.col("_i")), F.get("_highs", F.col("_i"))
    seen = _collect(
        _placed(long, by, groups).groupBy(*[col(b) for b in by], "_i").agg(
            F.count_if("_in").alias("rows"), F.count_if(~F.col("_in")).alias("gap"),
            F.count_if(inside == low).alias("at_low"), F.count_if(inside == high).alias("at_high"),
            F.min(F.when(inside > low, inside)).alias("next_low"), F.max(F.when(inside < high, inside)).alias("next_high"),
            F.percentile_approx(inside, grid, ACCURACY).alias("q")), by)
    for key, group in groups.items():
        if not group.open():
            continue
        intervals, position = group.intervals(), 0
        spans = []
        for i, (low, high) in enumerate(intervals):
            row = next(iter(seen.get(key, {}).get(i, [])), None)
            position += row["gap"] if row else 0
            rows = row["rows"] if row else 0
            spans.append((position, rows, low, high, row))
            position += rows
        for t in group.open():
            span = next((s for s in spans if s[0] <= t.rank < s[0] + s[1]), None)
            if span is None:  # the sketch missed: look in the whole group
                t.low, t.high, t.rows = group.low, group.high, float(group.size)
                continue
            first, rows, low, high, row = span
            at = (t.rank - first) / rows
            new_low = max((q for p, q in zip(grid, row["q"]) if p < at - edge), default=low)
            new_high = min((q for p, q in zip(grid, row["q"]) if p > at + edge), default=high)
            if (new_low, new_high) != (low, high):
                t.low, t.high, t.rows = new_low, new_high, rows * (1.0 / GRID + 2 * edge) * 2
            elif t.rank < first + row["at_low"]:
                t.answer = low
            elif t.rank >= first + rows - row["at_high"]:
                t.answer = high
            else:  # heavy values at both ends: what lies between them is known exactly, and smaller
                t.low, t.high = row["next_low"], row["next_high"]
                t.rows = float(rows - row["at_low"] - row["at_high"])


def _finish(long: DataFrame, by: list[str], groups: dict[tuple, _Group]) -> None:
    """Count the values inside the intervals and walk to the ranks."""
    value = F.when(F.col("_in"), F.col("_v")).alias("_value")
    seen = _collect(
        _placed(long, by, groups).groupBy(*[col(b) for b in by], "_i", value).agg(F.count(F.lit(1)).alias("_c")), by)
    for key, group in groups.items():
        pending = sorted(group.open(), key=lambda t: t.rank)
        position = 0
        for _, rows in sorted(seen.get(key, {}).items()):
            position += sum(r["_c"] for r in rows if r["_value"] is None)
            for v, c in sorted((r["_value"], r["_c"]) for r in rows if r["_value"] is not None):
                for t in pending:
                    if position <= t.rank < position + c:
                        t.answer = v
                position += c
        for t in pending:
            if t.answer is None:  # the sketch missed: look in the whole group
                t.low, t.high, t.rows = group.low, group.high, float(group.size)


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
                    keep_rows: int = KEEP_ROWS, with_counts: bool = False) -> dict:
    """Linear-interpolated quantiles as driver values: {column: [q…]} or {(group…, column): [q…]}.

    `with_counts` gives (row count, [q…]) instead.
    """
    if not columns:
        return {}

    def wanted(_, n):
        return [r for p in probs for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))]

    if len(columns) == 1 and not by:
        only = df.select(col(columns[0]).cast("double").alias("_value"))
        found = {(columns[0],): v for v in select_ranks(only, "_value", [], wanted, list(probs), keep_rows).values()}
    else:
        long = unpivot(df, columns, keep=by, name="_column", value="_value")
        found = select_ranks(long, "_value", [*by, "_column"], wanted, list(probs), keep_rows)
    out = {}
    for key, (n, at) in found.items():
        row = []
        for p in probs:
            position = p * (n - 1)
            lo, hi = at[math.floor(position)], at[math.ceil(position)]
            row.append(lo + (hi - lo) * (position - math.floor(position)))
        out[key if by else key[-1]] = (n, row) if with_counts else row
    for c in columns:
        if not by:
            out.setdefault(c, (0, [None] * len(probs)) if with_counts else [None] * len(probs))
    return out
