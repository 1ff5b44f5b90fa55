"""Connected components of a table of links, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.tables import checkpointed


def _downward(links: DataFrame) -> DataFrame:
    """Each link once, from its larger to its smaller end."""
    pairs = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    return pairs.filter("u <> v").distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, limit: int = 60) -> DataFrame:
    """(node, component): for every node of the links (a, b), the smallest node it is connected with.

    Links may be repeated, point to themselves or stand in either order; a node that is only linked with itself is not
    returned. Each round is joins and grouped minima, so a node with very many links is split like any skewed key, and
    the number of rounds grows with the logarithm of the longest chain. Raises if `limit` rounds are not enough.
    """
    now = checkpointed(_downward(links))
    seen = _state(now)
    for _ in range(limit):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        down = _downward(large)
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u")
        small = small.select(F.explode(F.array(
            F.struct(F.col("v").alias("a"), F.col("m").alias("b")), F.struct(F.col("u").alias("a"), F.col("m").alias("b"))
        )).alias("x")).select("x.a", "x.b")
        now = checkpointed(_downward(small))
        new = _state(now)
        if new == seen:
            ends = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return ends.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
        seen = new
    raise RuntimeError(f"links are not connected after {limit} rounds")
