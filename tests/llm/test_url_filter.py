from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tallyloom.llm import url_filter
from tallyloom.llm.queries import URL_RULES
from tests.llm.frames import CLASHING, collected


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string")
    names = dict.fromkeys([*CLASHING, "host", "path", "ruled", "features", "grams", "prediction", "rawPrediction"])
    return df.select("*", *[F.lit("x").alias(c) for c in names])


def brute(url):
    """(host, path, rule, verdict by rule)."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:end].translate({k: k + 32 for k in range(65, 91)}), rest[end:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    best = max((r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)), key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best and best.verdict


URLS = [
    None, "", "no scheme", "http://", "https://Example.ORG/es/1", "https://a.example.org/en/1?x=/es/", "https://notexample.org/es/2", "HTTP://ORG/",
    "https://x.org", "https://x.org?y", "https://x.com/fr/", "https://x.com/de/9#z", "https://com/de/", "https://x.com.net/de/", "://a.org/b",
    "ftp://u:p@h.com:80/fr/a", "a://b://c/d", "https://é.org/ü", "https://x.com/FR/1", "https://b.net/en/1\nx", "x://" + "a" * 9000 + ".com/de/" + "b" * 9000,
] + [f"https://s{i}.com/{'de' if i % 2 else 'fr'}/{i}" for i in range(60)] + [f"https://s{i}.info/{'de' if i % 2 else 'fr'}/{i}" for i in range(60)]


def test_host_path_and_rule_like_python(spark):
    rows = list(enumerate(URLS))
    got = collected(url_filter.judged(pages(spark, rows), URL_RULES), "page_id")
    for i, url in rows:
        host, path, rule, verdict = brute(url)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), url
        assert got[i]["verdict"] == verdict if verdict else got[i]["verdict"] in ("allow", "block")


def test_model_learns_what_rules_say_of_other_hosts(spark):
    rows = list(enumerate(URLS))
    got = collected(url_filter.judged(pages(spark, rows), URL_RULES), "page_id")
    other = [(i, u) for i, u in rows if u and ".info/" in u]
    right = [got[i]["verdict"] == ("block" if "/de/" in u else "allow") for i, u in other]
    assert np.mean(right) > 0.95 and all(got[i]["rule"] is None for i, _ in other)


def test_one_or_no_verdict_to_learn_from(spark):
    one = url_filter.judged(pages(spark, [(1, "https://a.org/x"), (2, "https://a.net/x")]), [url_filter.Rule("block", "org", "/")])
    assert {r["page_id"]: r["verdict"] for r in one.collect()} == {1: "block", 2: "block"}
    none = url_filter.judged(pages(spark, [(1, "https://a.org/x"), (None, None), (1, "y")]), [])
    assert [r["verdict"] for r in none.collect()] == ["allow"] * 3
    assert url_filter.judged(pages(spark, []), URL_RULES).count() == 0
