"""Feature importances: from a fitted model, or by shuffling one feature at a time."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from tallyloom.functions.columns import col, number, require, stable_hash

BUCKET_ROWS = 100_000


def model_importances(spark, model, features: Sequence[str], name: str = "model") -> DataFrame:
    """(model, feature, importance): absolute weights (mean over classes) or impurity gains."""
    core = model.stages[-1] if hasattr(model, "stages") else model
    if hasattr(core, "coefficientMatrix"):
        values = np.abs(core.coefficientMatrix.toArray()).mean(axis=0)
    elif hasattr(core, "coefficients"):
        values = np.abs(np.array(core.coefficients))
    elif hasattr(core, "featureImportances"):
        values = core.featureImportances.toArray()
    else:
        raise TypeError("the model has neither weights nor importances; use permutation_importance")
    rows = sorted(((name, f, float(v)) for f, v in zip(features, values)), key=lambda r: (-r[2], r[1]))
    return spark.createDataFrame(rows, "model string, feature string, importance double")


def importances(spark, model, rows: DataFrame, features: Sequence[str], key: str, name: str,
                score: Callable[[DataFrame, list[str]], DataFrame], repeats: int = 10, seed: int = 42) -> DataFrame:
    """(model, feature, importance) from the model where it has weights or gains, else by permutation on `rows`."""
    core = model.stages[-1] if hasattr(model, "stages") else model
    if any(hasattr(core, x) for x in ("coefficientMatrix", "coefficients", "featureImportances")):
        return model_importances(spark, model, features, name)
    found = permutation_importance(rows, model.transform, score, features, key, repeats, seed)
    return found.select(F.lit(name).alias("model"), "feature", "importance")


def shuffled(df: DataFrame, features: Sequence[str], key: str, repeats: int, seed: int, buckets: int) -> DataFrame:
    """(rows, repeat, feature, features…): every row once per repeat and feature, that feature taken from another row.

    Rows are dealt into buckets by hash.  A repeat pairs each row with the one a random number of
    places further in the hash order of its bucket, which is a permutation of the bucket.  One
    order and one join serve all features and repeats.
    """
    bucket = F.pmod(stable_hash([key], f"{seed}:bucket"), F.lit(buckets)).alias("_bucket")
    inside = Window.partitionBy("_bucket").orderBy("_h")
    rows = df.withColumn("_h", stable_hash([key], seed)).withColumn("_bucket", bucket)
    size = F.count(F.lit(1)).over(Window.partitionBy("_bucket")).cast("int")
    placed = rows.withColumns({"_at": F.row_number().over(inside) - 1, "_size": size}).drop("_h")
    donors = placed.select(F.col("_bucket").alias("_b"), F.col("_at").alias("_from"),
                           *[number(f).alias(f"_d{i}") for i, f in enumerate(features)])
    asked = placed.withColumn("repeat", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    shift = 1 + F.pmod(stable_hash(["_bucket", "repeat"], seed), F.greatest(F.col("_size") - 1, F.lit(1)))
    asked = asked.withColumn("_want", F.pmod(F.col("_at") + shift, F.col("_size")).cast("int"))
    paired = asked.join(donors, (F.col("_bucket") == F.col("_b")) & (F.col("_want") == F.col("_from")))
    versions = F.array(*[
        F.struct(F.lit(f).alias("feature"), *[
            (F.col(f"_d{i}") if i == j else number(g)).alias(f"_n{j}") for j, g in enumerate(features)
        ]) for i, f in enumerate(features)
    ])
    rest = [c for c in df.columns if c not in features]
    return paired.select(*[col(c) for c in rest], "repeat", F.inline(versions)).select(
        *[col(c) for c in rest], "repeat", "feature", *[F.col(f"_n{j}").alias(g) for j, g in enumerate(features)])


def permutation_importance(df: DataFrame, predict: Callable[[DataFrame], DataFrame], score: Callable[[DataFrame, list[str]], DataFrame],
                           features: Sequence[str], key: str, repeats: int = 10, seed: int = 42,
                           buckets: int | None = None) -> DataFrame:
    """(feature, importance, deviation): the mean loss of score when the feature is shuffled.

    `predict` adds a prediction to rows; `score(rows, by)` returns (by…, score).
    """
    require(df, key, *features)
    if buckets is None:
        buckets = max(1, math.ceil(df.count() / BUCKET_ROWS))
    base = score(predict(df), []).select("score").scalar()
    trials = score(predict(shuffled(df, features, key, repeats, seed, buckets)), ["feature", "repeat"])
    return (
        trials.withColumn("_base", base).withColumn("_loss", F.col("_base") - F.col("score"))
        .groupBy("feature").agg(F.avg("_loss").alias("importance"), F.stddev_pop("_loss").alias("deviation"))
    )
