"""Quality of documents: a classifier's evidence combined with posteriors of their host and path.

1. A logistic regression on shape features of the text (repetition, capitals, symbols, digits, word lengths) gives each
   document evidence: its log odds less those of the labels.
2. The expected good documents of every host, and of every path within it, are summed over all documents. A host's rate
   is shrunk toward the global rate, and a path's rate toward its host's, by pseudo-counts estimated from the spread
   between hosts and between paths. A document's own part is left out of the sums that judge it.
3. Log odds of a document = evidence + log odds of its path's rate.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.logistic import Logistic, fit
from tallyloom.llm.shingles import seeds, words
from tallyloom.llm.tables import byte_blocks, checkpointed, columns_of, ordered, stored, whole

#: Labelled rows that the classifier is fitted on at most.
MAX_ROWS = 20_000
#: Pseudo-counts stay between these, however even or uneven the sites are.
LEAST, MOST = 10.0, 1e5
_BATCH = 256

_KINDS = np.zeros((256, 6))
_KINDS[65:91, 0] = 1  # capitals
_KINDS[97:123, 1] = 1  # small letters
_KINDS[48:58, 2] = 1  # digits
_KINDS[[ord(c) for c in "#$%&*|<>{}[]\\^~=+@_"], 3] = 1
_KINDS[[ord(c) for c in "!?"], 4] = 1
_KINDS[128:, 5] = 1  # beyond ASCII
FEATURES = ("capitals", "digits", "symbols", "exclaimed", "beyond_ascii", "repeated_word", "repeated_pair", "word_bytes", "words")


def features(texts: list[bytes]) -> np.ndarray:
    """One row of FEATURES for each text; an empty text has zeros."""
    block = b"\n".join(texts)
    out = np.zeros((len(texts), len(FEATURES)))
    if not texts:
        return out
    raw = np.frombuffer(block + b"\n", dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    begins = ends - [len(t) + 1 for t in texts]
    starts, hashes = words(block)
    cuts = np.concatenate([[0], np.searchsorted(starts, ends)])
    follow = np.zeros(len(hashes), dtype=bool)
    follow[1:] = hashes[1:] == hashes[:-1]
    factors = seeds(2, 53) | np.uint64(1)
    pairs = hashes.copy()
    pairs[:-1] = hashes[:-1] * factors[0] + hashes[1:] * factors[1]
    for k, (a, b, i, j) in enumerate(zip(begins.tolist(), ends.tolist(), cuts[:-1].tolist(), cuts[1:].tolist())):
        if j == i:
            continue
        n = j - i
        kinds = np.bincount(raw[a : b - 1], minlength=256) @ _KINDS
        size = b - 1 - a
        letters = max(1.0, kinds[0] + kinds[1])
        out[k, :5] = kinds[0] / letters, kinds[2] / size, kinds[3] / size, kinds[4] / size, kinds[5] / size
        out[k, 5] = follow[i + 1 : j].mean() if n > 1 else 0.0
        out[k, 6] = 1 - len(np.unique(pairs[i : j - 1])) / (n - 1) if n > 1 else 0.0
        out[k, 7] = np.log1p(min(40.0, size / n))
        out[k, 8] = np.log1p(n)
    # Long clean texts repeat pairs by chance: only the part beyond what their length explains counts.
    out[:, 6] = np.maximum(0.0, out[:, 6] - 0.04 * out[:, 8])
    return out


def _feature_rows(rows: DataFrame) -> DataFrame:
    @F.pandas_udf("array<double>")
    def make(text: pd.Series) -> pd.Series:
        parts = [features([t.encode() for t in text[a:b]]) for a, b in byte_blocks(list(map(len, text)), _BATCH)]
        return pd.Series([list(r) for p in parts for r in p])

    return rows.withColumn("x", make("text"))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
    max_rows: int = MAX_ROWS,
) -> Logistic:
    """Fitted on the `max_rows` labelled documents that come first by a hash of their id; NULL ids and labels are left out,
    repeated labels count by their mean."""
    named = columns_of(labels, id=id_col, label=label_col).dropna().groupBy("id").agg(F.avg("label").alias("label"))
    some = named.orderBy(ordered("id"), "id").limit(max_rows)
    rows = columns_of(docs, id=id_col, text=text_col).join(F.broadcast(some), "id").select(whole("text").alias("text"), "label")
    got = _feature_rows(rows).select("x", (F.col("label") > 0.5).cast("double").alias("y")).toPandas()
    x = np.array(got["x"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    return fit(x, got["y"].to_numpy(dtype=float), ridge=1e-4)


def evidence(model: Logistic, text: Column) -> Column:
    """Log odds of a text beyond those of the labels."""

    @F.pandas_udf("double")
    def judge(text: pd.Series) -> pd.Series:
        texts = text.tolist()
        parts = [model.log_odds(features([t.encode() for t in texts[a:b]])) for a, b in byte_blocks(list(map(len, texts)), _BATCH)]
        return pd.Series(np.concatenate(parts) - model.base if parts else [], dtype="float64")

    return judge(F.coalesce(text, F.lit("")))


def _probability(log_odds: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.least(log_odds, F.lit(30.0)), F.lit(-30.0))))


def _name(column: str) -> Column:
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("\x00none"))


def _pseudo_count(groups: DataFrame) -> float:
    """Pseudo-count of (n, good, center): how far groups' rates spread around their centre beyond chance."""
    gap = F.col("good") - F.col("n") * F.col("center")
    chance = F.col("n") * F.col("center") * (1 - F.col("center"))
    got = groups.filter("n > 1").agg(F.sum(gap * gap).alias("seen"), F.sum(chance).alias("chance"),
                                     F.sum(chance * (F.col("n") - 1)).alias("more")).first()
    if not got["more"]:
        return LEAST
    shared = max(0.0, (got["seen"] - got["chance"]) / got["more"])  # the correlation of two documents of a group
    return float(min(MOST, max(LEAST, (1 - shared) / shared if shared > 0 else MOST)))


def site_rates(rows: DataFrame, base: float) -> tuple[DataFrame, dict]:
    """((host, path, site), settings) of rows (host, path, evidence); site: (n, good, host_n, host_good)."""
    good = _probability(F.col("evidence") + base)
    paths = checkpointed(rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(good).alias("good")))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("good").alias("host_good"))
    total = paths.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    rate = (total["good"] + 1) / (total["n"] + 2) if total["n"] else 0.5
    k_host = _pseudo_count(hosts.select(F.col("host_n").alias("n"), F.col("host_good").alias("good"), F.lit(rate).alias("center")))
    sites = paths.join(hosts, "host").select("host", "path", F.struct("n", "good", "host_n", "host_good").alias("site"))
    sites = stored(sites, "sites")
    center = (F.col("site.host_good") + k_host * rate) / (F.col("site.host_n") + k_host)
    k_path = _pseudo_count(sites.select("site.n", "site.good", center.alias("center")))
    return sites, {"rate": rate, "k_host": k_host, "k_path": k_path, "base": base}


def posterior(found: dict, seen: Column, site: Column) -> tuple[Column, Column, Column]:
    """(host rate, path rate, log odds) of a row with evidence `seen` and its site's sums, without its own part."""
    own = _probability(seen + found["base"])
    k_host, k_path = found["k_host"], found["k_path"]
    host = (site["host_good"] - own + k_host * found["rate"]) / (site["host_n"] - 1 + k_host)
    path = (site["good"] - own + k_path * host) / (site["n"] - 1 + k_path)
    path = F.greatest(F.least(path, F.lit(1 - 1e-6)), F.lit(1e-6))
    return host, path, seen + F.log(path / (1 - path))


def scores(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    path_col: str = "lang", label_col: str = "quality", threshold: float = 0.5, max_rows: int = MAX_ROWS,
) -> DataFrame:
    """(id, evidence, host_rate, path_rate, score, accepted) of each document; accepted: score >= threshold.

    `documents` has no url, so by default `source` stands for the host and `lang` for the path.

    NULL and empty texts are judged by the features of an empty text, NULL hosts and paths are sites of their own, ids
    may be NULL or repeated. Without labels of both kinds the evidence is zero. An empty table gives no rows; further
    columns are ignored.
    """
    model = train(docs, labels, id_col, text_col, label_col, max_rows)
    rows = columns_of(docs, id=id_col, text=text_col, host=host_col, path=path_col)
    rows = checkpointed(rows.select("id", _name("host").alias("host"), _name("path").alias("path"), evidence(model, F.col("text")).alias("evidence")))
    sites, found = site_rates(rows, model.base)
    host, path, odds = posterior(found, F.col("evidence"), F.col("site"))
    judged = rows.join(sites, ["host", "path"]).select(
        F.col("id").alias(id_col), "evidence", host.alias("host_rate"), path.alias("path_rate"), _probability(odds).alias("score"))
    return judged.withColumn("accepted", F.col("score") >= threshold)


def accepted(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    path_col: str = "lang", label_col: str = "quality", threshold: float = 0.5, max_rows: int = MAX_ROWS,
) -> DataFrame:
    """The documents whose score reaches the threshold, in their own columns and with their repeated rows."""
    model = train(docs, labels, id_col, text_col, label_col, max_rows)
    rows = columns_of(docs, text=text_col, host=host_col, path=path_col)
    rows = rows.select(_name("host").alias("host"), _name("path").alias("path"), evidence(model, F.col("text")).alias("evidence"))
    sites, found = site_rates(rows, model.base)
    sites = sites.toDF("_tl_host", "_tl_path", "_tl_site")
    marked = docs.withColumns({
        "_tl_host": _name(host_col), "_tl_path": _name(path_col), "_tl_evidence": evidence(model, F.col(f"`{text_col}`"))})
    *_, odds = posterior(found, F.col("_tl_evidence"), F.col("_tl_site"))
    marked = marked.join(sites, ["_tl_host", "_tl_path"]).filter(_probability(odds) >= threshold)
    return marked.drop("_tl_host", "_tl_path", "_tl_evidence", "_tl_site")
