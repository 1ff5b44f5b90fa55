"""Threshold curves of a scored table: ROC, precision-recall, best threshold and averaged curves.

Rows collapse to one row per distinct score before any ordering, and running totals are taken in
score buckets, so neither a large class nor a repeated score meets in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.functions.columns import col, number
from tallyloom.functions.running import bucket_count, running_totals
from tallyloom.functions.stats import divide, divide_or_zero
from tallyloom.session import checkpointed

# Fixed values of the threshold search.
F1_GUARD = 1e-8
DEFAULT_THRESHOLD = 0.5


def one_vs_rest(df: DataFrame, label: str, scores: Mapping[object, str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form (keep…, class, score, hit) with one row per case and class."""
    cells = F.array(*[
        F.struct(F.lit(cls).alias("class"), number(score).alias("score"), (col(label) == F.lit(cls)).cast("int").alias("hit"))
        for cls, score in scores.items()
    ])
    return df.select(*[col(k) for k in keep], F.inline(cells))


def score_counts(df: DataFrame, hit: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per group and distinct score with its hits and misses."""
    return df.groupBy(*[col(b) for b in by], number(score).alias("score")).agg(
        F.sum(col(hit).cast("long")).alias("pos"), F.sum((1 - col(hit)).cast("long")).alias("neg"))


def _cumulated(df: DataFrame, hit: str, score: str, by: Sequence[str], following: Sequence[str] = ()) -> DataFrame:
    """Running hits and misses from the highest score down, with the totals of the group."""
    counts = score_counts(df, hit, score, by)
    run = running_totals(counts, "score", ["pos", "neg"], by=by, descending=True, following=following)
    if not by:
        totals = counts.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n")).alias("t")).scalar()
        return run.withColumn("_t", totals).withColumns({"_p": F.col("_t.p"), "_n": F.col("_t.n")}).drop("_t")
    totals = counts.groupBy(*[col(b).alias(f"_b_{b}") for b in by]).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    match = F.lit(True)
    for b in by:
        match = match & col(b).eqNullSafe(col(f"_b_{b}"))
    return run.join(totals, match).drop(*[f"_b_{b}" for b in by])


def roc_curve(df: DataFrame, hit: str, score: str, by: Sequence[str] = (), drop_intermediate: bool = True) -> DataFrame:
    """(by…, threshold, fpr, tpr) from the highest score down, starting at the origin (threshold infinity).

    `drop_intermediate` leaves out points between equal steps, which lie on a straight line.
    """
    following = ["pos", "neg"] if drop_intermediate else []
    run = _cumulated(df, hit, score, by, following)
    if drop_intermediate:
        first = (F.col("cum_pos") == F.col("pos")) & (F.col("cum_neg") == F.col("neg"))
        turns = ~(F.col("pos").eqNullSafe(F.col("next_pos")) & F.col("neg").eqNullSafe(F.col("next_neg")))
        run = run.filter(first | turns)
    keys = [col(b) for b in by]
    points = run.select(*keys, F.col("score").alias("threshold"), divide(F.col("cum_neg"), F.col("_n")).alias("fpr"),
                        divide(F.col("cum_pos"), F.col("_p")).alias("tpr"))
    return points.unionByName(_start(df, by, F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")))


def _start(df: DataFrame, by: Sequence[str], *cells: Column) -> DataFrame:
    """The fixed first point of the curve of every group."""
    groups = df.select(*[col(b) for b in by]).distinct() if by else df.sparkSession.range(1)
    return groups.select(*[col(b) for b in by], *cells)


def pr_curve(df: DataFrame, hit: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """(by…, threshold, recall, precision) for every distinct score, and the end point (recall 0, precision 1)."""
    run = _cumulated(df, hit, score, by)
    points = run.select(
        *[col(b) for b in by], F.col("score").alias("threshold"), divide(F.col("cum_pos"), F.col("_p")).alias("recall"),
        divide(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg")).alias("precision"),
    )
    end = _start(df, by, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("recall"), F.lit(1.0).alias("precision"))
    return points.unionByName(end)


def curve_areas(df: DataFrame, hit: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Areas under the ROC and the precision-recall curve by trapezoids.

    The point before a score follows from the running totals less the score's own counts, so
    neighbouring rows are never joined.
    """
    run = _cumulated(df, hit, score, by)
    tp, fp = F.col("cum_pos"), F.col("cum_neg")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")
    p, n = F.col("_p"), F.col("_n")
    roc = divide(F.col("neg"), n) * (divide(tp, p) + divide(tp0, p)) / 2
    precision = divide(tp, tp + fp)
    before = F.when(tp0 + fp0 > 0, divide(tp0, tp0 + fp0)).otherwise(1.0)
    pr = divide(F.col("pos"), p) * (precision + before) / 2
    return run.groupBy(*[col(b) for b in by]).agg(
        F.max(p).alias("positives"), F.max(n).alias("negatives"), F.sum(roc).alias("roc_auc"), F.sum(pr).alias("pr_auc"))


def macro_areas(df: DataFrame, label: str, scores: Mapping[object, str], by: Sequence[str] = ()) -> DataFrame:
    """Unweighted mean of the one-vs-rest areas."""
    long = one_vs_rest(df, label, scores, by)
    areas = curve_areas(long, "hit", "score", [*by, "class"])
    return areas.groupBy(*[col(b) for b in by]).agg(
        F.count(F.lit(1)).alias("classes"), F.avg("roc_auc").alias("macro_roc_auc"), F.avg("pr_auc").alias("macro_pr_auc"))


def best_threshold(df: DataFrame, hit: str, score: str, by: Sequence[str] = (), minimum_precision: float | None = None,
                   minimum_recall: float | None = None) -> DataFrame:
    """The threshold with the highest F1, the lowest of equals; 0.5 when no threshold scores.

    Optional floors restrict the search to thresholds that meet them.
    """
    run = _cumulated(df, hit, score, by)
    precision = divide_or_zero(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))
    recall = divide_or_zero(F.col("cum_pos"), F.col("_p"))
    rows = run.select(*[col(b) for b in by], F.col("score").alias("threshold"), precision.alias("precision"), recall.alias("recall"))
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + F1_GUARD)
    rows = rows.withColumn("f1", f1)
    allowed = F.col("f1") > 0
    if minimum_precision is not None:
        allowed = allowed & (F.col("precision") >= minimum_precision)
    if minimum_recall is not None:
        allowed = allowed & (F.col("recall") >= minimum_recall)
    point = F.struct("threshold", "f1", "precision", "recall")
    order = F.when(allowed, F.struct("f1", (-F.col("threshold")).alias("low")))
    best = rows.groupBy(*[col(b) for b in by]).agg(F.max_by(point, order).alias("best"))
    return best.select(
        *[col(b) for b in by], F.coalesce("best.threshold", F.lit(DEFAULT_THRESHOLD)).alias("threshold"),
        F.coalesce("best.f1", F.lit(0.0)).alias("f1"), F.col("best.precision").alias("precision"),
        F.col("best.recall").alias("recall"),
    )


def apply_threshold(df: DataFrame, score: str, threshold: Column | float, name: str = "prediction") -> DataFrame:
    return df.withColumn(name, (number(score) >= threshold).cast("int"))


# averaged curves ----------------------------------------------------------------------------------------------------

def _curve_points(df: DataFrame, label: str, scores: Mapping[object, str], kind: str) -> DataFrame:
    """(class, x, entry, leave): first and last height of each class curve at each of its x."""
    long = one_vs_rest(df, label, scores)
    if kind == "roc":
        curve, x, y, entry, leave = roc_curve(long, "hit", "score", ["class"]), "fpr", "tpr", F.min, F.max
    elif kind == "pr":
        curve, x, y, entry, leave = pr_curve(long, "hit", "score", ["class"]), "recall", "precision", F.max, F.min
    else:
        raise ValueError(f"kind must be 'roc' or 'pr', got {kind!r}")
    return curve.groupBy("class", F.col(x).alias("x")).agg(entry(y).alias("entry"), leave(y).alias("leave"))


def mean_curve(df: DataFrame, label: str, scores: Mapping[object, str], kind: str = "roc",
               buckets: int | None = None) -> DataFrame:
    """(x, y): mean height of the class curves, interpolated linearly on all x of any class.

    The x of a curve are multiples of one over a class size, hence spread evenly: equal ranges of x
    are the buckets, as many as the number of points asks for.  Inside a bucket a window finds the neighbouring points, and the nearest points
    of other buckets come from one row per class and bucket.
    """
    points = _curve_points(df, label, scores, kind)
    if buckets is None:
        points = checkpointed(points)
        buckets = bucket_count(points.count() * len(scores))
    bucket = F.least(F.floor(F.col("x") * buckets), F.lit(buckets - 1)).cast("int")
    every_class = F.array(*[F.lit(c) for c in scores])
    grid = points.select("x").distinct().select(F.explode(every_class).alias("class"), "x")
    rows = grid.join(points, ["class", "x"], "left").withColumn("bucket", bucket)
    known = F.col("entry").isNotNull()
    rows = rows.select("class", "x", "bucket", "entry", "leave",
                       F.when(known, F.struct("x", F.col("leave").alias("y"))).alias("from"),
                       F.when(known, F.struct("x", F.col("entry").alias("y"))).alias("to"))

    inside = Window.partitionBy("class", "bucket").orderBy("x")
    back = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ahead = inside.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    local = rows.withColumns({"_from": F.last("from", ignorenulls=True).over(back),
                              "_to": F.first("to", ignorenulls=True).over(ahead)})
    ends = rows.groupBy("class", "bucket").agg(
        F.max_by("from", F.when(F.col("from").isNotNull(), F.col("x"))).alias("last"),
        F.min_by("to", F.when(F.col("to").isNotNull(), F.col("x"))).alias("first"))
    across = Window.partitionBy("class").orderBy("bucket")
    carried = ends.select(
        F.col("class").alias("_class"), F.col("bucket").alias("_bucket"),
        F.last("last", ignorenulls=True).over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
        F.first("first", ignorenulls=True).over(across.rowsBetween(1, Window.unboundedFollowing)).alias("_after"))
    joined = local.join(carried, (F.col("class") == F.col("_class")) & (F.col("bucket") == F.col("_bucket")))
    left, right = F.coalesce("_from", "_before"), F.coalesce("_to", "_after")
    slope = divide(right["y"] - left["y"], right["x"] - left["x"])
    between = F.coalesce(left["y"] + slope * (F.col("x") - left["x"]), left["y"], right["y"])
    height = F.coalesce(F.col("leave"), between)
    return joined.groupBy("x").agg(F.avg(height).alias("y"))


def curve_area(curve: DataFrame, x: str = "x", y: str = "y", buckets: int | None = None) -> DataFrame:
    """Area under (x, y) points with x in [0, 1] by trapezoids; the x are distinct and evenly spread."""
    rows = curve.select(number(x).alias("x"), number(y).alias("y"))
    if buckets is None:
        rows = checkpointed(rows)
        buckets = bucket_count(rows.count())
    rows = rows.withColumn(
        "bucket", F.least(F.floor(F.col("x") * buckets), F.lit(buckets - 1)).cast("int"))
    point = F.struct("x", "y")
    inside = Window.partitionBy("bucket").orderBy("x")
    ends = rows.groupBy("bucket").agg(F.max_by(point, F.col("x")).alias("_end"))
    carried = ends.select(F.col("bucket").alias("_at"), F.lag("_end").over(Window.partitionBy(F.lit(1)).orderBy("bucket")).alias("_carry"))
    steps = rows.withColumn("_prev", F.lag(point).over(inside)).join(carried, F.col("bucket") == F.col("_at"))
    prev = F.coalesce("_prev", "_carry")
    return steps.agg(F.coalesce(F.sum((F.col("x") - prev["x"]) * (F.col("y") + prev["y"]) / 2), F.lit(0.0)).alias("area"))
