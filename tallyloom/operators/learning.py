"""Learning curve: scores of a candidate fitted on growing parts of the training folds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from tallyloom.functions.columns import col, stable_hash
from tallyloom.functions.selection import select_ranks
from tallyloom.operators.models import LABEL, Candidate, classes_of, fit_model, scored, with_code
from tallyloom.operators.search import FOLD, check_metric, score_table
from tallyloom.operators.split import class_sizes, with_folds

# Ten sizes from a tenth to all of the training rows.
SIZES = tuple(i / 10 for i in range(1, 11))


def learning_curve(candidate: Candidate, params: Mapping, df: DataFrame, label: str, features: Sequence[str], key: str,
                   metric: str = "accuracy", sizes: Sequence[float] = SIZES, folds: int = 5, seed: int = 42,
                   parallelism: int = 4) -> DataFrame:
    """(size, rows, train_mean, train_std, valid_mean, valid_std), deviations over the folds.

    A part is the rows of the training folds below a cut in hash order, so parts are nested; the
    cuts are exact order statistics, found for all folds and sizes together.
    """
    check_metric(metric, candidate.task)
    rows = df.select(col(key), col(label), *[col(f) for f in features])
    if candidate.task == "classification":
        rows = with_code(rows, label, classes_of(rows, label))
        scarce = min(class_sizes(rows, LABEL).values()) < 2
        folded = with_folds(rows, [key], folds, None if scarce else LABEL, seed, FOLD)
    else:
        folded = with_folds(rows.withColumn(LABEL, col(label).cast("double")), [key], folds, None, seed, FOLD)
    folded = folded.withColumn("_place", stable_hash([key], f"{seed}:part")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        every_fold = F.array(*[F.lit(i) for i in range(folds)])
        usable = folded.select(F.explode(F.filter(every_fold, lambda f: f != F.col(FOLD))).alias("out"), "_place")
        found = select_ranks(usable, "_place", ["out"], lambda _, n: [max(int(s * n), 1) - 1 for s in sizes], list(sizes))

        def one(job: tuple[int, float]):
            fold, size = job
            n, at = found[(fold,)]
            take = max(int(size * n), 1)
            part = F.when(F.col(FOLD) == fold, "valid").when(F.col("_place") <= F.lit(at[take - 1]), "train")
            used = folded.withColumn("_part", part).filter("_part IS NOT NULL")
            model = fit_model(candidate, params, used.filter("_part = 'train'"), features, take, seed)
            scores = {r["_part"]: r["score"] for r in score_table(scored(model, used, ["_part"]), metric, ["_part"]).collect()}
            return size, take, scores.get("train"), scores.get("valid")

        jobs = [(fold, size) for size in sizes for fold in range(folds)]
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            points = list(pool.map(inheritable_thread_target(df.sparkSession)(one), jobs))
    finally:
        folded.unpersist()
    table = df.sparkSession.createDataFrame(points, "size double, rows long, train double, valid double")
    return table.groupBy("size").agg(
        F.min("rows").alias("rows"), F.avg("train").alias("train_mean"), F.stddev_pop("train").alias("train_std"),
        F.avg("valid").alias("valid_mean"), F.stddev_pop("valid").alias("valid_std"))
