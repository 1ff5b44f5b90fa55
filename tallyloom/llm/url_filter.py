"""URL filter: rules for hosts and paths, and for all other urls a logistic regression on hashed n-grams.

The regression is trained on a small labelled table of urls: those that a rule decides, with the rule's verdict. Its
features are the counts of character n-grams of the host and of the path, hashed into buckets. Training and scoring run
in Spark's own ML operators; no Python touches a url.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.tables import columns_of, ordered, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Lengths of n-grams, buckets, and labelled urls that the model is fitted on at most.
GRAMS, BUCKETS, MAX_ROWS = (3, 4), 1 << 14, 20_000


@dataclass(frozen=True)
class Rule:
    """Fits its host and all subdomains, if the url's path starts with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host after the first '://', A-Z lower-cased, and the path after it up to '?' or '#'; both empty without '://'."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def ruled(rows: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rows (host, path) with rule and ruled: the name and verdict of the longest rule that fits, else NULL."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)) & F.col("path").startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return rows.withColumns({"rule": name, "ruled": verdict})


def _grams_of(column: str, n: int) -> Column:
    text = F.concat(F.lit("^"), F.col(column), F.lit("$"))
    last = F.length(text) - n + 1
    places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.concat(F.lit(f"{column} "), F.substring(text, i, F.lit(n))))


def grams(sizes: tuple[int, ...] = GRAMS) -> Column:
    """The n-grams of host and path, each marked with where it comes from; their ends are marked too."""
    return F.concat(*[_grams_of(column, n) for column in ("host", "path") for n in sizes])


def train(urls: DataFrame, labels: dict[str, float], buckets: int = BUCKETS, max_rows: int = MAX_ROWS) -> PipelineModel | None:
    """From labelled urls (host, path, verdict): the `max_rows` that come first by a hash. None without two verdicts."""
    label = F.when(F.col("verdict") == "block", F.lit(labels["block"])).otherwise(F.lit(labels["allow"]))
    some = urls.select("host", "path", label.alias("label")).distinct()
    some = stored(some.orderBy(ordered("host", "path"), "host", "path").limit(max_rows), "urls")
    if some.select("label").distinct().count() < 2:
        return None
    hashed = HashingTF(inputCol="grams", outputCol="features", numFeatures=buckets)
    fitted = LogisticRegression(regParam=0.001, maxIter=30, standardization=False).fit(
        hashed.transform(some.coalesce(1).withColumn("grams", grams())))
    return PipelineModel([hashed, fitted])


def judged(
    pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", buckets: int = BUCKETS,
    max_rows: int = MAX_ROWS, otherwise: str = "allow",
) -> DataFrame:
    """(id, host, path, rule, verdict) of every url; the model decides where no rule fits.

    A url that is NULL or has no '://' has an empty host and path, and is judged by the model like any other. Where the
    rules give no two verdicts to learn from, such urls get the one there is, or `otherwise`. Ids may be NULL or
    repeated. An empty table gives no rows; further columns are ignored.
    """
    rows = columns_of(pages, id=id_col, url=url_col)
    host, path = host_and_path(F.col("url"))
    rows = ruled(rows.select("id", host.alias("host"), path.alias("path")), rules)
    known = rows.filter("ruled IS NOT NULL").select("host", "path", F.col("ruled").alias("verdict"))
    model = train(known, {"allow": 0.0, "block": 1.0}, buckets, max_rows)
    if model is None:
        one = known.agg(F.max("verdict")).first()[0]
        rows = rows.withColumn("verdict", F.coalesce("ruled", F.lit(one or otherwise)))
    else:
        scored = model.transform(rows.withColumn("grams", grams()))
        guess = F.when(F.col("prediction") > 0.5, F.lit("block")).otherwise(F.lit("allow"))
        rows = scored.withColumn("verdict", F.coalesce("ruled", guess))
    return rows.select(F.col("id").alias(id_col), "host", "path", "rule", "verdict")
