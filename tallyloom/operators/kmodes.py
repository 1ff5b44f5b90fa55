"""k-modes clustering of categorical rows, and imputation from the mode of a row's cluster.

Rows collapse to distinct value combinations with a weight.  A round is one job over the
combinations: the current modes are literals, a combination goes to the mode it differs from
least, and the new modes are the heaviest values per cluster and column.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from tallyloom.functions.columns import col, require
from tallyloom.session import checkpointed

MISSING_TOKEN = "__missing__"


def _mismatches(names: Sequence[str], mode: Sequence[str]) -> Column:
    total = F.lit(0)
    for name, value in zip(names, mode):
        total = total + (F.col(name) != value).cast("int")
    return total


@dataclass(frozen=True)
class KModes:
    """init="Cao" starts from dense, distant combinations; "Huang" draws from the value frequencies."""

    n_clusters: int = 5
    init: str = "Huang"
    n_init: int = 5
    max_iter: int = 100
    seed: int = 42

    def fit(self, df: DataFrame, columns: Sequence[str]) -> FittedKModes:
        require(df, *columns)
        names = [f"v{i}" for i in range(len(columns))]
        rows = df.select(*[F.coalesce(col(c).cast("string"), F.lit(MISSING_TOKEN)).alias(n) for c, n in zip(columns, names)])
        combos = checkpointed(rows.groupBy(*names).agg(F.count(F.lit(1)).alias("w")))
        found = combos.count()
        if found == 0:
            raise ValueError("no rows to cluster")
        if found <= self.n_clusters:
            modes = [tuple(r[n] for n in names) for r in combos.orderBy(*names).collect()]
            return FittedKModes(list(columns), modes, 0)
        if self.init == "Cao":
            starts = [self._cao(combos, names)]
        elif self.init == "Huang":
            starts = [self._huang(combos, names, self.seed + i) for i in range(self.n_init)]
        else:
            raise ValueError(f"init must be 'Huang' or 'Cao', got {self.init!r}")
        runs = [self._iterate(combos, names, s) for s in starts]
        cost, modes = min(runs, key=lambda r: r[0])
        return FittedKModes(list(columns), modes, cost)

    def _values(self, combos: DataFrame, names: Sequence[str]) -> DataFrame:
        cells = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in names])
        return combos.select("w", F.inline(cells)).groupBy("name", "value").agg(F.sum("w").alias("f"))

    def _cao(self, combos: DataFrame, names: Sequence[str]) -> list[tuple]:
        """First the densest combination, then by largest product of density and distance to those chosen."""
        frequencies = self._values(combos, names)
        dense = combos
        for n in names:
            own = frequencies.filter(F.col("name") == n).select(F.col("value").alias(f"_{n}"), F.col("f").alias(f"f_{n}"))
            dense = dense.join(own, F.col(n) == F.col(f"_{n}")).drop(f"_{n}")
        dense = checkpointed(dense.select(*names, sum([F.col(f"f_{n}") for n in names[1:]], F.col(f"f_{names[0]}")).alias("d")))
        modes: list[tuple] = []
        while len(modes) < self.n_clusters:
            gaps = [_mismatches(names, m) * F.col("d") for m in modes]
            score = F.col("d") if not gaps else (gaps[0] if len(gaps) == 1 else F.least(*gaps))
            best = dense.orderBy(score.desc(), *names).select(*names).first()
            modes.append(tuple(best))
        return modes

    def _huang(self, combos: DataFrame, names: Sequence[str], seed: int) -> list[tuple]:
        """Draw each mode value by frequency, then move every draw to its closest combination not yet taken."""
        u = (F.pmod(F.xxhash64("name", "value", F.lit(seed)), F.lit(2**31)) + 1) / F.lit(2.0**31 + 1)
        drawn = self._race(combos, names, u)
        pick = random.Random(seed)
        modes: list[tuple] = []
        for i in range(self.n_clusters):
            draft = [drawn[n][i] if i < len(drawn[n]) else pick.choice(drawn[n]) for n in names]
            taken = F.lit(False)
            for m in modes:
                taken = taken | (_mismatches(names, m) == 0)
            closest = combos.filter(~taken).orderBy(_mismatches(names, draft), *names).select(*names).first()
            modes.append(tuple(closest))
        return modes

    def _race(self, combos: DataFrame, names: Sequence[str], u: Column) -> dict[str, list[str]]:
        """Weighted draws without replacement: the smallest exponential keys per column, a top-n per column."""
        keyed = self._values(combos, names).withColumn("key", -F.log(u) / F.col("f"))
        return {
            n: [r["value"] for r in keyed.filter(F.col("name") == n).orderBy("key", "value").limit(self.n_clusters).collect()]
            for n in names
        }

    def _iterate(self, combos: DataFrame, names: Sequence[str], modes: list[tuple]) -> tuple[int, list[tuple]]:
        best_cost, best = None, modes
        for _ in range(self.max_iter):
            cost, fresh = self._round(combos, names, modes)
            if best_cost is not None and cost >= best_cost:
                break
            best_cost, best = cost, modes
            if fresh == modes:
                break
            modes = fresh
        return best_cost, best

    def _round(self, combos: DataFrame, names: Sequence[str], modes: list[tuple]) -> tuple[int, list[tuple]]:
        """Cost of the current modes and the modes that follow from their clusters."""
        away = F.array(*[_mismatches(names, m) for m in modes])
        placed = combos.withColumn("_away", away).select(
            *names, "w", F.array_min("_away").alias("_miss"),
            (F.array_position("_away", F.array_min("_away")) - 1).alias("cluster"))
        cells = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("value")) for n in names])
        counted = (
            placed.select("cluster", "w", (F.col("w") * F.col("_miss")).alias("cost"), F.inline(cells))
            .groupBy("cluster", "name", "value").agg(F.sum("w").alias("f"), F.sum("cost").alias("cost"))
        )
        heaviest = counted.groupBy("cluster", "name").agg(
            F.min_by("value", F.struct((-F.col("f")).alias("f"), "value")).alias("value"), F.sum("cost").alias("cost"))
        fresh = [list(m) for m in modes]
        cost = 0
        for r in heaviest.collect():
            fresh[r["cluster"]][names.index(r["name"])] = r["value"]
            cost += r["cost"] if r["name"] == names[0] else 0
        return cost, [tuple(m) for m in fresh]


@dataclass(frozen=True)
class FittedKModes:
    columns: list[str]
    modes: list[tuple]
    cost: int

    def cluster(self, missing_as: Sequence[str] = ()) -> Column:
        """Cluster index of a row; the texts in `missing_as` count as missing."""
        if not self.modes:
            return F.lit(None).cast("int")
        values = []
        for c in self.columns:
            text = col(c).cast("string")
            if missing_as:
                text = F.when(~text.isin(list(missing_as)), text)
            values.append(F.coalesce(text, F.lit(MISSING_TOKEN)))
        away = F.array(*[
            sum([(v != m).cast("int") for v, m in zip(values[1:], mode[1:])], (values[0] != mode[0]).cast("int"))
            for mode in self.modes
        ])
        return (F.array_position(away, F.array_min(away)) - 1).cast("int")

    def transform(self, df: DataFrame, name: str = "cluster") -> DataFrame:
        return df.withColumn(name, self.cluster())


@dataclass(frozen=True)
class KModesImputer:
    """Fill a text column with the most frequent value in the row's cluster over other columns."""

    columns_for_clustering: Sequence[str] = field(default_factory=tuple)
    n_clusters: int = 5
    init: str = "Huang"
    n_init: int = 5
    placeholder: str = "unknown"
    seed: int = 42

    def fit(self, df: DataFrame, target: str) -> FittedKModesImputer:
        absent = [c for c in self.columns_for_clustering if c not in df.columns]
        if absent:
            raise KeyError(f"columns not found: {absent}")
        require(df, target)
        known = {c: F.when(col(c).cast("string") != self.placeholder, col(c).cast("string")) for c in self.columns_for_clustering}
        model = KModes(self.n_clusters, self.init, self.n_init, seed=self.seed).fit(
            df.select(*[v.alias(c) for c, v in known.items()]), list(self.columns_for_clustering))
        labelled = df.select(
            model.cluster([self.placeholder]).alias("cluster"), col(target).alias("value")
        ).filter(F.col("value").isNotNull() & (F.col("value") != self.placeholder))
        counted = labelled.groupBy("cluster", "value").agg(F.count(F.lit(1)).alias("n"))
        best = counted.groupBy("cluster").agg(F.min_by("value", F.struct((-F.col("n")).alias("n"), "value")).alias("value"))
        fill = {i: self.placeholder for i in range(len(model.modes))}
        fill.update({r["cluster"]: r["value"] for r in best.collect()})
        return FittedKModesImputer(target, model, fill, self.placeholder)


@dataclass(frozen=True)
class FittedKModesImputer:
    target: str
    model: FittedKModes
    fill: dict[int, str]
    placeholder: str

    def imputed(self) -> Column:
        values = F.array(*[F.lit(self.fill[i]) for i in range(len(self.model.modes))])
        guess = F.get(values, self.model.cluster([self.placeholder]))
        return F.when(col(self.target).isNull() | (col(self.target) == self.placeholder), guess).otherwise(col(self.target))

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.target, self.imputed())
