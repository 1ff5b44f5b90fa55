"""Exact nearest neighbours without forming all pairs, and the k-nearest-neighbour imputer.

Equal points are one point with a few of its rows.  Distinct points are laid out in balanced cells
from a bounded sample.  Each query first searches the cells around it, which bounds the distance of
its neighbours, then only those other cells whose box lies within that bound.  A cell searched by
many queries is searched by several tasks, each with a share of the queries.

Points of a group that miss the same coordinates are a space. Only spaces of more than a cell have a tree, and there are
few of those; the others are one cell each, numbered in a table, however many there are. The boxes of up to `MAX_BOXES` cells
go to every task; those of more are a table too, whose blocks meet the queries of their group.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tallyloom.functions.cells import box_bounds, build_tree, distances, leaf_of
from tallyloom.functions.columns import col, missing_names, number, require
from tallyloom.functions.dictionary import coded, dictionary
from tallyloom.session import checkpointed

CELL_POINTS = 2048
MAX_CELLS = 8192
SAMPLE_PER_CELL = 32
QUERIES_PER_TASK = 4096
BLOCK = 512
MAX_BOXES = 50_000
BLOCK_CELLS = 4096


def point(features: Sequence[str]) -> Column:
    """Feature vector with NaN for a missing cell; negative zero counts as zero."""
    return F.array(*[F.coalesce(number(f) + F.lit(0.0), F.lit(float("nan"))) for f in features])


def _pattern(vector: Column) -> Column:
    """Which coordinates are present, as a text of 0 and 1."""
    return F.array_join(F.transform(vector, lambda x: F.when(F.isnan(x), "0").otherwise("1")), "")


def numbered(df: DataFrame, key: str, name: str = "_number") -> tuple[DataFrame, str]:
    """The frame with a bigint for its key, and that column's name: the key itself if it is a whole number, else its rank."""
    if isinstance(df.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return df, key
    ranks = dictionary(df, {key: col(key)})
    return coded(df, ranks, 0, col(key), name, F.lit(None).cast("double")).withColumn(name, F.col(name).cast("long")), name


@dataclass
class _Layout:
    """Trees of the spaces that have one, how many cells those are, and all spaces with their first cell."""

    trees: dict[tuple[str, str], tuple[int, np.ndarray, np.ndarray]]
    tree_cells: int
    spaces: DataFrame
    count: int

    @property
    def single(self) -> bool:
        """One cell holds all points."""
        return self.count == 1 and not self.trees


def _plan_layout(points: DataFrame, cell_points: int) -> _Layout:
    """Cells per space in proportion to its points; trees from a hash sample of bounded size."""
    counted = points.groupBy("group", "pattern").agg(F.count(F.lit(1)).alias("n"))
    counted = checkpointed(counted.withColumn("id", F.monotonically_increasing_id()))
    whole = counted.agg(F.count(F.lit(1)).alias("spaces"), F.coalesce(F.sum("n"), F.lit(0)).alias("points")).first()
    total = whole["points"]
    share = max(cell_points, math.ceil(total / MAX_CELLS))
    large = counted.filter(F.col("n") > share).collect()  # fewer than MAX_CELLS
    depth = {(s["group"], s["pattern"]): math.ceil(math.log2(s["n"] / share)) for s in large if "1" in s["pattern"]}
    cells = sum(2**d for d in depth.values())
    wanted = cells * SAMPLE_PER_CELL
    sampled: dict[tuple[str, str], list] = {}
    if depth:
        span = 2**31
        edge = min(span, math.ceil(span * min(1.0, 1.5 * wanted / total)))
        picked = points.filter(F.pmod(F.xxhash64("vector"), F.lit(span)) < edge)
        for r in picked.select("group", "pattern", "vector").limit(2 * wanted).collect():
            if (r["group"], r["pattern"]) in depth:
                sampled.setdefault((r["group"], r["pattern"]), []).append(r["vector"])
    trees, first = {}, 0
    for space, d in depth.items():
        present = [i for i, flag in enumerate(space[1]) if flag == "1"]
        rows = np.array(sampled.get(space, []), dtype=float).reshape(-1, len(space[1]))
        if len(rows) < 2:
            continue
        dims, cuts = build_tree(rows[:, present], d)
        trees[space] = (first, np.array(present, dtype=np.int64)[dims], cuts)
        first += 2**d
    return _Layout(trees, first, counted, whole["spaces"])


def _with_cell(points: DataFrame, layout: _Layout) -> DataFrame:
    """Cells of trees are numbered first, then the spaces without one."""
    if layout.single:
        return points.withColumn("cell", F.lit(0).cast("long"))
    own = layout.spaces.select("group", "pattern", (F.col("id") + layout.tree_cells).alias("cell"))
    placed = points.join(own, ["group", "pattern"])
    if not layout.trees:
        return placed
    trees = points.sparkSession.sparkContext.broadcast(layout.trees)

    @F.pandas_udf("long")
    def leaf(vector: pd.Series, group: pd.Series, pattern: pd.Series, cell: pd.Series) -> pd.Series:
        out = cell.to_numpy().copy()
        rows = np.array(vector.tolist(), dtype=float)
        for space, at in pd.DataFrame({"g": group, "p": pattern}).groupby(["g", "p"]).indices.items():
            if tuple(space) in trees.value:
                first, dims, cuts = trees.value[tuple(space)]
                out[at] = first + leaf_of(rows[at], dims, cuts)
        return pd.Series(out)

    return placed.withColumn("cell", leaf("vector", "group", "pattern", "cell"))


@dataclass
class _Boxes:
    """The cells that hold points: rows and box of each, as a table, and as arrays unless there are very many."""

    table: DataFrame
    arrays: object | None
    blocks: DataFrame | None


def _read_boxes(placed: DataFrame, width: int) -> _Boxes:
    low = F.array(*[F.min(F.col("vector")[i]) for i in range(width)]).alias("low")
    high = F.array(*[F.max(F.col("vector")[i]) for i in range(width)]).alias("high")
    boxes = checkpointed(placed.groupBy("group", "cell").agg(F.sum(F.size("members")).alias("rows"), low, high))
    if boxes.count() > MAX_BOXES:
        blocks = boxes.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / BLOCK_CELLS).cast("int").alias("blocks"))
        return _Boxes(boxes, None, blocks)
    found = boxes.collect()
    arrays = (
        np.array([r["cell"] for r in found], dtype=np.int64), np.array([r["group"] for r in found], dtype=object),
        np.array([r["rows"] for r in found], dtype=np.int64), np.array([r["low"] for r in found], dtype=float).reshape(-1, width),
        np.array([r["high"] for r in found], dtype=float).reshape(-1, width))
    # plain arrays: a broadcast is unpickled before any code arrives
    return _Boxes(boxes, placed.sparkSession.sparkContext.broadcast(arrays), None)


def _nearest_cells(part: pd.DataFrame, cells, rows, low, high, wanted: int):
    """The nearest cells of each query that together hold enough rows."""
    vectors = np.array(part["vector"].tolist(), dtype=float)
    for start in range(0, len(part), BLOCK):
        bounds = box_bounds(vectors[start:start + BLOCK], low, high)
        order = np.argsort(bounds, axis=1, kind="stable")
        near = np.take_along_axis(bounds, order, 1)
        held = np.cumsum(np.where(np.isinf(near), 0, rows[order]), axis=1)
        needed = np.minimum((held < wanted).sum(axis=1) + 1, len(cells))
        takes = (np.arange(len(cells))[None, :] < needed[:, None]) & ~np.isinf(near)
        at, place = np.nonzero(takes)
        ids = part["qid"].to_numpy()[start:start + BLOCK]
        picked = order[at, place]
        yield pd.DataFrame({
            "qid": ids[at], "cell": cells[picked], "reach": np.full(len(at), np.inf),
            "vector": [vectors[start + i] for i in at], "bound": near[at, place], "rows": rows[picked]})


def _cells_in_reach(part: pd.DataFrame, cells, rows, low, high, wanted: int):
    """Cells not searched yet whose box comes within reach of the query."""
    vectors = np.array(part["vector"].tolist(), dtype=float)
    reach, ids, done = part["reach"].to_numpy(), part["qid"].to_numpy(), part["done"].to_list()
    for start in range(0, len(part), BLOCK):
        bounds = box_bounds(vectors[start:start + BLOCK], low, high)
        # the bound and the distance round differently: leave room for the last digits
        within = (bounds * (1 - 1e-9) <= reach[start:start + BLOCK, None]) & ~np.isinf(bounds)
        for i, tried in enumerate(done[start:start + BLOCK]):
            within[i] &= ~np.isin(cells, tried)
        at, place = np.nonzero(within)
        yield pd.DataFrame({
            "qid": ids[start:start + BLOCK][at], "cell": cells[place], "reach": reach[start:start + BLOCK][at],
            "vector": [vectors[start + i] for i in at], "bound": bounds[at, place], "rows": rows[place]})


_PROBE = "qid long, cell long, reach double, vector array<double>, bound double, rows long"


def _probes(queries: DataFrame, boxes: _Boxes, pick, wanted: int) -> DataFrame:
    """The cells that `pick` chooses for each query."""
    if boxes.arrays is not None:
        shared = boxes.arrays

        def search(batches):
            cells, groups, rows, low, high = shared.value
            for batch in batches:
                for group, part in batch.groupby("group", sort=False):
                    mine = np.flatnonzero(groups == group)
                    if len(mine):
                        yield from pick(part, cells[mine], rows[mine], low[mine], high[mine], wanted)

        return queries.mapInPandas(search, _PROBE)

    # Each block of a group's cells meets the group's queries, in shares of QUERIES_PER_TASK.
    shares = queries.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / QUERIES_PER_TASK).cast("int").alias("shares"))
    sizes = checkpointed(boxes.blocks.join(shares, "group"))
    asked = queries.join(sizes.toDF("group", "_blocks", "_shares"), "group").withColumns({
        "share": F.pmod(F.xxhash64("qid"), F.col("_shares")).cast("int"),
        "block": F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))}).drop("_blocks", "_shares")
    held = boxes.table.join(sizes.toDF("group", "_b", "_s"), "group").withColumns({
        "block": F.pmod(F.xxhash64("cell"), F.col("_b")).cast("int"),
        "share": F.explode(F.sequence(F.lit(0), F.col("_s") - 1))}).drop("_b", "_s")

    def meet(part: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({c: [] for c in ("qid", "cell", "reach", "vector", "bound", "rows")})
        if not len(part) or not len(own):
            return empty
        ends = [np.array(own[c].tolist(), dtype=float).reshape(len(own), -1) for c in ("low", "high")]
        return pd.concat([empty, *pick(part, own["cell"].to_numpy(), own["rows"].to_numpy(), *ends, wanted)])

    keys = ["group", "block", "share"]
    return asked.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(meet, _PROBE)


def _first_cells(queries: DataFrame, boxes: _Boxes, wanted: int) -> DataFrame:
    """The nearest cells of each query that together hold enough rows; of several blocks, the nearest of all."""
    found = _probes(queries.select("qid", "group", "vector"), boxes, _nearest_cells, wanted)
    if boxes.arrays is None:
        ahead = Window.partitionBy("qid").orderBy("bound", "cell").rowsBetween(Window.unboundedPreceding, -1)
        found = found.withColumn("_ahead", F.coalesce(F.sum("rows").over(ahead), F.lit(0))).filter(F.col("_ahead") < wanted)
    return found.select("qid", "cell", "reach", "vector")


def _other_cells(queries: DataFrame, boxes: _Boxes, wanted: int) -> DataFrame:
    """Cells not searched yet whose box comes within reach of the query."""
    asked = queries.select("qid", "group", "vector", "reach", "done")
    return _probes(asked, boxes, _cells_in_reach, wanted).select("qid", "cell", "reach", "vector")


def _search(probes: DataFrame, placed: DataFrame, wanted: int, payload_type: T.DataType) -> DataFrame:
    """Nearest rows of each probed cell: (qid, cell, distance, key, payload), at most `wanted` per probe."""
    loads = probes.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / QUERIES_PER_TASK).cast("int").alias("shares"))
    left = probes.join(loads, "cell").withColumn("share", F.pmod(F.xxhash64("qid"), F.col("shares")).cast("int"))
    right = placed.join(loads, "cell").withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)))
    out = T.StructType([
        T.StructField("qid", T.LongType()), T.StructField("cell", T.LongType()), T.StructField("distance", T.DoubleType()),
        T.StructField("key", T.LongType()), T.StructField("payload", payload_type),
    ])

    def nearest(key, probe: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"qid": [], "cell": [], "distance": [], "key": [], "payload": []})
        if not len(probe) or not len(held):
            return empty
        points = np.array(held["vector"].tolist(), dtype=float)
        owner = np.repeat(np.arange(len(held)), held["members"].map(len))
        keys = np.array([m["key"] for ms in held["members"] for m in ms], dtype=np.int64)
        payloads = [m["payload"] for ms in held["members"] for m in ms]
        starts = np.concatenate([[0], np.cumsum(held["members"].map(len).to_numpy())])
        vectors = np.array(probe["vector"].tolist(), dtype=float)
        ids, reach = probe["qid"].to_numpy(), probe["reach"].to_numpy()
        found_q, found_d, found_m = [], [], []
        for start in range(0, len(probe), BLOCK):
            away = distances(vectors[start:start + BLOCK], points)
            away = np.where(np.isnan(away), np.inf, away)
            cut = np.partition(away, min(wanted, away.shape[1]) - 1, axis=1)[:, min(wanted, away.shape[1]) - 1]
            cut = np.minimum(cut, reach[start:start + BLOCK])
            for i in range(len(away)):
                close = np.flatnonzero((away[i] <= cut[i]) & np.isfinite(away[i]))
                rows = np.concatenate([np.arange(starts[c], starts[c + 1]) for c in close]) if len(close) else close
                order = np.lexsort((keys[rows], away[i][owner[rows]]))[:wanted]
                best = rows[order]
                found_q.append(np.full(len(best), ids[start + i]))
                found_d.append(away[i][owner[best]])
                found_m.append(best)
        chosen = np.concatenate(found_m).astype(np.int64)
        return pd.DataFrame({
            "qid": np.concatenate(found_q).astype(np.int64), "cell": np.full(len(chosen), key[0], dtype=np.int64),
            "distance": np.concatenate(found_d), "key": keys[chosen], "payload": [payloads[m] for m in chosen],
        })

    return (
        left.groupBy("cell", "share").cogroup(right.select("cell", "share", "vector", "members").groupBy("cell", "share"))
        .applyInPandas(nearest, out)
    )


def nearest_rows(queries: DataFrame, candidates: DataFrame, features: Sequence[str], key: str, payload: Column, k: int,
                 group: str | None = None, cell_points: int = CELL_POINTS) -> DataFrame:
    """(group, vector, neighbours): for every distinct query point its k+1 nearest candidate rows.

    `neighbours` is sorted by distance, then key, and holds structs (distance, key, payload).  One
    row more than k lets a caller leave out the query row itself.  `key` must be a bigint that
    identifies a candidate; `numbered` gives one for a key of another type.
    """
    wanted = k + 1
    tag = col(group).cast("string") if group else F.lit("")
    rows = candidates.select(tag.alias("group"), point(features).alias("vector"), col(key).cast("long").alias("key"),
                             payload.alias("payload"))
    payload_type = rows.schema["payload"].dataType
    # a row number with a limit is cut in every task before the shuffle, so a crowded point stays small
    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy("group", "vector").orderBy("key"))).filter(F.col("_r") <= wanted)
    points = ranked.groupBy("group", "vector").agg(F.sort_array(F.collect_list(F.struct("key", "payload"))).alias("members"))
    points = checkpointed(points.withColumn("pattern", _pattern(F.col("vector"))))
    layout = _plan_layout(points, cell_points)
    several = not layout.single
    placed = checkpointed(_with_cell(points, layout)) if several else _with_cell(points, layout)

    asked = queries.select(tag.alias("group"), point(features).alias("vector")).distinct()
    asked = checkpointed(asked.withColumn("qid", F.monotonically_increasing_id()))
    best = F.slice(F.sort_array(F.collect_list(F.struct("distance", "key", "payload"))), 1, wanted).alias("neighbours")
    if not layout.count:
        none = F.array().cast(T.ArrayType(T.StructType([
            T.StructField("distance", T.DoubleType()), T.StructField("key", T.LongType()), T.StructField("payload", payload_type)])))
        return asked.select("group", "vector", none.alias("neighbours"))
    if several:
        boxes = _read_boxes(placed, len(features))
        probes = checkpointed(_first_cells(asked, boxes, wanted))
        first = checkpointed(_search(probes, placed, wanted, payload_type))
        tried = probes.groupBy("qid").agg(F.collect_list("cell").alias("done"))
        reached = first.groupBy("qid").agg(best).select(
            F.col("qid").alias("_q"),
            F.when(F.size("neighbours") >= wanted, F.element_at("neighbours", -1)["distance"]).alias("reach"))
        second = asked.join(tried, "qid").join(reached, F.col("qid") == F.col("_q"), "left").withColumn(
            "reach", F.coalesce("reach", F.lit(float("inf"))))
        more = checkpointed(_other_cells(second, boxes, wanted))
        found = first.unionByName(_search(more, placed, wanted, payload_type))
    else:
        probes = asked.select("qid", F.lit(0).cast("long").alias("cell"), F.lit(float("inf")).alias("reach"), "vector")
        found = _search(probes, placed, wanted, payload_type)
    merged = found.groupBy("qid").agg(best).withColumnRenamed("qid", "_q")
    return asked.join(merged, F.col("qid") == F.col("_q"), "left").select(
        "group", "vector", F.coalesce("neighbours", F.array().cast(merged.schema["neighbours"].dataType)).alias("neighbours"))


def attach_neighbours(df: DataFrame, found: DataFrame, features: Sequence[str], group: str | None = None) -> DataFrame:
    """Give each row the neighbours of its point."""
    tag = col(group).cast("string") if group else F.lit("")
    return (
        df.withColumns({"_group": tag, "_vector": point(features)})
        .join(found.select(F.col("group").alias("_g"), F.col("vector").alias("_v"), "neighbours"),
              F.col("_group").eqNullSafe(F.col("_g")) & (F.col("_vector") == F.col("_v")), "left")
        .drop("_group", "_vector", "_g", "_v")
    )


def others(neighbours: str, key: str, k: int) -> Column:
    """The k nearest neighbours of a row, itself left out."""
    return F.slice(F.filter(F.col(neighbours), lambda x: x["key"] != col(key).cast("long")), 1, k)


@dataclass(frozen=True)
class KNNImputer:
    """Fill a gap with the mean of that column over the k nearest rows that have it.

    Distance is Euclidean over the columns both rows have.  A row without any comparable donor gets
    the column mean.
    """

    k: int = 5
    cell_points: int = CELL_POINTS

    def fit(self, df: DataFrame, columns: Sequence[str], key: str) -> FittedKNNImputer:
        require(df, key, *columns)
        df, key = numbered(df, key)
        means = df.agg(*[F.avg(number(c)).alias(f"m{i}") for i, c in enumerate(columns)]).first()
        return FittedKNNImputer(self, df.select(col(key), *[col(c) for c in columns]), list(columns), key,
                                {c: means[f"m{i}"] for i, c in enumerate(columns)})


@dataclass(frozen=True)
class FittedKNNImputer:
    spec: KNNImputer
    donors: DataFrame
    columns: list[str]
    key: str
    means: dict[str, float]

    def transform(self, df: DataFrame) -> DataFrame:
        """All gaps are filled from the rows as they came: a filled cell is never a donor.

        One search serves all columns: a column is a group whose candidates are the rows that have it.
        """
        gapped = sorted(missing_names(df, self.columns), key=self.columns.index)
        if not gapped:
            return df
        cells = F.array(*[F.struct(F.lit(c).alias("_column"), number(c).alias("_value")) for c in gapped])
        held = self.donors.select("*", F.inline(cells)).filter("_value IS NOT NULL")
        asked = df.select(*[col(c) for c in self.columns], F.inline(cells)).filter("_value IS NULL")
        found = nearest_rows(asked, held, self.columns, self.key, F.col("_value"), self.spec.k, group="_column",
                             cell_points=self.spec.cell_points)
        near = F.slice("neighbours", 1, self.spec.k)
        mean = F.when(F.size(near) > 0, F.aggregate(near, F.lit(0.0), lambda s, x: s + x["payload"]) / F.size(near))
        values = found.withColumn("_mean", mean).groupBy(F.col("vector").alias("_v")).agg(
            *[F.max(F.when(F.col("group") == c, F.col("_mean"))).alias(f"_f{i}") for i, c in enumerate(gapped)])
        # rows without a gap carry no vector, so they meet nothing
        incomplete = F.when(F.greatest(*[col(c).isNull() for c in gapped], F.lit(False)), point(self.columns))
        joined = df.withColumn("_p", incomplete).join(values, F.col("_p") == F.col("_v"), "left")
        filled = {c: F.coalesce(number(c), F.col(f"_f{i}"), F.lit(self.means[c])) for i, c in enumerate(gapped)}
        return joined.withColumns(filled).select(*[col(c) for c in df.columns])
