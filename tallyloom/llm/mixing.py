"""Mixing sources to target weights by temperature.

A source's weight is its share of the tokens raised to an exponent between 0 (all sources equal) and 1 (as they are).
The exponent is bisected: each pass over the table of sources measures entropy and repetition at several exponents and
keeps the interval that holds the answer. It is the largest exponent whose entropy reaches the target, raised further
if a source would be repeated more often than allowed.

The weights are realised under a budget of tokens. A source is a permutation of blocks of documents for each epoch:
blocks are put in an order, and documents within a block. Whole epochs are drawn in full; the last epoch is cut where
the source's budget ends. The cut is one place in the order, found from sums over blocks and then within one block, so
whether a document is drawn is decided by comparing its place with the cut.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.tables import checkpointed, columns_of, ordered, stored, whole

#: Documents in a block, about.
BLOCK_DOCS = 4096
WORD = r"[^\x20\x09-\x0D]+"
_POINTS, _PASSES = 17, 6


@dataclass(frozen=True)
class Mixture:
    """exponent, its normaliser sum(share ** exponent), the drawn budget, the corpus' tokens, the entropy it reaches."""

    exponent: float
    normaliser: float
    budget: float
    tokens: int
    entropy: float


def word_tokens(text: Column) -> Column:
    """A document's tokens when no tokenizer is given: its words and the end of the document."""
    return F.regexp_count(text, F.lit(WORD)) + F.lit(1)


def _name(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("\x00none"))


def sources_of(rows: DataFrame) -> DataFrame:
    """(source, docs, tokens) of rows (source, tokens), written once."""
    return stored(rows.groupBy("source").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens")), "sources")


def _measures(sources: DataFrame, total: int, exponents: list[float]) -> list[tuple[float, float, float]]:
    """(normaliser, entropy, largest weight / share) at each exponent, in one pass."""
    share = F.col("tokens") / F.lit(float(total))
    at = sources.select(F.log(share).alias("l"), F.explode(F.array(*[F.lit(a) for a in exponents])).alias("a"))
    power = F.exp(F.col("a") * F.col("l"))
    got = at.groupBy("a").agg(F.sum(power).alias("z"), F.sum(power * F.col("l")).alias("s"), F.min("l").alias("l")).collect()
    found = {r["a"]: r for r in got}
    out = []
    for a in exponents:
        r = found[a]
        out.append((r["z"], math.log(r["z"]) - a * r["s"] / r["z"], math.exp((a - 1) * r["l"]) / r["z"]))
    return out


def _turn(sources: DataFrame, total: int, beyond) -> tuple[float, float]:
    """The exponents between which `beyond` turns from false to true; twice the same end if it never turns."""
    low, high = 0.0, 1.0
    for k in range(_PASSES):
        points = [low + (high - low) * i / (_POINTS - 1) for i in range(_POINTS)]
        marks = [beyond(a, *m) for a, m in zip(points, _measures(sources, total, points))]
        if k == 0 and (marks[0] or not marks[-1]):
            return (0.0, 0.0) if marks[0] else (1.0, 1.0)
        first = marks.index(True) if True in marks else _POINTS - 1
        low, high = points[max(0, first - 1)], points[first]
    return low, high


def temperature(
    sources: DataFrame, entropy: float = 0.9, repetitions: float = 4.0, budget: float | None = None,
) -> Mixture | None:
    """The mixture of (source, docs, tokens); `entropy` is a part of the largest possible one, that of equal weights.

    Without a budget it is the smallest at which no document is lost: the source that is damped most is drawn once.
    A budget that repeats documents too often even as they are gives the exponent 1. None for a table without sources.
    """
    got = sources.agg(F.count("*").alias("n"), F.sum("tokens").alias("t"), F.max("tokens").alias("m")).first()
    if not got["n"]:
        return None
    total, target, largest = got["t"], entropy * math.log(got["n"]), math.log(got["m"] / got["t"])

    def drawn(a: float, z: float) -> float:
        # the weight of the largest source falls below its share most
        return float(budget) if budget is not None else total * max(1.0, z / math.exp((a - 1) * largest))

    by_entropy, _ = _turn(sources, total, lambda a, z, h, ratio: h < target - 1e-12)
    _, by_limit = _turn(sources, total, lambda a, z, h, ratio: ratio * drawn(a, z) / total <= repetitions + 1e-9)
    exponent = max(by_entropy, by_limit)
    ((z, h, _),) = _measures(sources, total, [exponent])
    return Mixture(exponent, z, drawn(exponent, z), total, h)


def _place(seed: int, blocks: Column, epoch: Column) -> tuple[Column, Column, Column]:
    """(block, place of the block, place in the block) of a row with `_tl_key` in an epoch."""
    block = F.pmod(ordered("_tl_key", seed=seed), blocks)
    return block, ordered(block, epoch, seed=seed + 1), ordered("_tl_key", epoch, seed=seed + 2)


def cuts(rows: DataFrame, sources: DataFrame, mixture: Mixture, seed: int = 0) -> DataFrame:
    """(source, plan): weight, whole epochs, blocks, and the cut of the epoch after them.

    A row of that epoch is drawn if its (place of block, place in block) is at most the cut; a cut of NULL draws none.
    """
    weight = F.exp(mixture.exponent * F.log(F.col("tokens") / F.lit(float(mixture.tokens)))) / mixture.normaliser
    shares = sources.select("source", "docs", "tokens", weight.alias("weight"))
    shares = shares.withColumn("epochs", F.floor(F.col("weight") * mixture.budget / F.col("tokens") + 1e-9).cast("int"))
    shares = shares.select(
        "source", "weight", "epochs", (F.col("weight") * mixture.budget - F.col("epochs") * F.col("tokens")).alias("rest"),
        F.ceil(F.col("docs") / BLOCK_DOCS).alias("blocks"))
    block, at, place = _place(seed, F.col("blocks"), F.col("epochs"))
    dealt = rows.join(shares.select("source", "blocks", "epochs", "rest"), "source").select(
        "source", "rest", "tokens", block.alias("block"), at.alias("at"), place.alias("place"))
    sums = checkpointed(dealt.groupBy("source", "block", "at").agg(F.sum("tokens").alias("sum"), F.max("rest").alias("rest")))
    before = Window.partitionBy("source").orderBy("at", "block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("before", F.coalesce(F.sum("sum").over(before), F.lit(0)))
    broken = sums.filter((F.col("before") < F.col("rest")) & (F.col("before") + F.col("sum") > F.col("rest")))
    broken = broken.select("source", "block", F.col("at").alias("cut_block"), "before")
    upto = Window.partitionBy("source", "block").orderBy("place")  # rows of one place, copies of an id, together
    inner = dealt.join(broken, ["source", "block"])
    inner = inner.withColumn("upto", F.sum("tokens").over(upto) + F.col("before")).filter("upto <= rest")
    ends = broken.join(inner.groupBy("source").agg(F.max("place").alias("cut_place")), "source", "left")
    whole_blocks = sums.filter(F.col("before") + F.col("sum") <= F.col("rest")).groupBy("source").agg(F.max("at").alias("full"))
    planned = shares.join(ends.select("source", "cut_block", "cut_place"), "source", "left").join(whole_blocks, "source", "left")
    plan = F.struct(
        "weight", "epochs", "blocks", F.coalesce("cut_block", "full").alias("cut_block"),
        F.when(F.col("cut_block").isNull(), F.lit((1 << 63) - 1)).otherwise(F.col("cut_place")).alias("cut_place"))
    return stored(planned.select("source", plan.alias("plan")), "cuts")


def _times(plan: Column, seed: int) -> Column:
    """How often a row with `_tl_key` and its source's plan is drawn."""
    _, at, place = _place(seed, plan["blocks"], plan["epochs"])
    partly = (at < plan["cut_block"]) | ((at == plan["cut_block"]) & (place <= plan["cut_place"]))
    return plan["epochs"] + F.coalesce(partly, F.lit(False)).cast("int")


def _planned(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, tokens_col: str | None, seed: int, settings: dict,
) -> tuple[DataFrame, DataFrame | None]:
    tokens = F.coalesce(F.col(f"`{tokens_col}`"), F.lit(0)) if tokens_col else word_tokens(whole(f"`{text_col}`"))
    rows = docs.select(F.col(f"`{id_col}`").alias("_tl_key"), _name(source_col).alias("source"), tokens.cast("long").alias("tokens"))
    rows = checkpointed(rows)
    sources = sources_of(rows.filter("tokens > 0"))
    mixture = temperature(sources, **settings)
    return rows, mixture and cuts(rows, sources, mixture, seed)


def draws(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    tokens_col: str | None = None, seed: int = 0, **settings,
) -> DataFrame:
    """One row for each time a document is drawn: (id, source, tokens, weight, epoch, block_place, place).

    In training order, a source's rows go by epoch, block_place and place. Settings are those of `temperature`. Tokens
    are the words and one, or `tokens_col`; sources without tokens are not drawn. A NULL source is a source of its own,
    returned as NULL. Rows that share an id are drawn together. An empty table gives no rows; further columns are ignored.
    """
    rows, plans = _planned(docs, id_col, text_col, source_col, tokens_col, seed, settings)
    kind = dict(rows.dtypes)["_tl_key"]
    if plans is None:
        return rows.sparkSession.createDataFrame([], f"`{id_col}` {kind}, source string, tokens long, weight double, epoch int, block_place long, place long")
    plan = F.col("plan")
    times = F.transform(F.array_repeat(F.lit(0), _times(plan, seed)), lambda _, i: i)
    drawn = rows.join(plans, "source").select("*", F.explode(times).alias("epoch"))
    _, at, place = _place(seed, plan["blocks"], F.col("epoch"))
    return drawn.select(
        F.col("_tl_key").alias(id_col), F.when(F.col("source") != "\x00none", F.col("source")).alias("source"), "tokens",
        plan["weight"].alias("weight"), "epoch", at.alias("block_place"), place.alias("place"))


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    tokens_col: str | None = None, seed: int = 0, **settings,
) -> DataFrame:
    """The documents as often as they are drawn, in their own columns."""
    _, plans = _planned(docs, id_col, text_col, source_col, tokens_col, seed, settings)
    if plans is None:
        return docs
    keyed = docs.withColumns({"_tl_key": F.col(f"`{id_col}`"), "_tl_source": _name(source_col)})
    keyed = keyed.join(plans.toDF("_tl_source", "_tl_plan"), "_tl_source")
    repeated = keyed.withColumn("_tl_copy", F.explode(F.array_repeat(F.lit(0), _times(F.col("_tl_plan"), seed))))
    return repeated.drop("_tl_key", "_tl_source", "_tl_plan", "_tl_copy")
