"""One query for each operator over its whole table, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm import (
    conversation_repair, exact_dedup, hamming_search, mixing, near_dedup, packing, phrases, quality, secrets, substring_dedup,
    token_scan, toxicity, url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: <|endoftext|> of that vocabulary.
END_OF_TEXT = 49407

URL_RULES = [
    url_filter.Rule("allow", "org", "/"), url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"), url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
]


def _query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query("op7_exact_dedup", r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256 FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
""")
def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicates(_table(spark, sf_dir, "documents"))


@_query("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), TOKENIZER, capacity=2048, end_id=0)


@_query("op3_minhash_near_dedup", r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION
  SELECT r.x, l.y FROM reach r JOIN (SELECT x, y FROM links UNION ALL SELECT y, x FROM links) l ON l.x = r.y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id, r.component_id = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) r USING (doc_id)
""")
def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


@_query("op1_secret_scan", r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
p(kind, pattern) AS (VALUES
  (0, '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
  (1, 'AKIA[A-Z0-9]{16,}'), (2, '[0-9a-f]{24,}'), (3, '[A-Za-z0-9+/_=-]{16,}')),
h AS (SELECT doc_id, kind, pattern, regexp_extract_all(text, pattern) AS hits, string_split_regex(text, pattern) AS gaps FROM t, p),
u AS (SELECT doc_id, kind, pattern, hits, gaps, unnest(range(1, len(hits) + 1)) AS i FROM h WHERE len(hits) > 0),
s AS (
  SELECT doc_id, kind, pattern, hits[i] AS hit,
         CAST(list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS a
  FROM u),
found AS (SELECT doc_id, kind, hit, a, a + length(hit) AS z FROM s WHERE kind > 0 OR length(regexp_extract(hit, pattern, 2)) >= 6),
base AS (SELECT doc_id, kind, a, z FROM found WHERE kind < 3),
seg AS (
  SELECT doc_id, a, z, hit, regexp_extract_all(hit, '[A-Za-z0-9+/_-]+=*') AS parts, length(regexp_extract(hit, '^=*')) AS lead FROM found WHERE kind = 3),
part AS (SELECT *, unnest(range(1, len(parts) + 1)) AS j FROM seg WHERE len(parts) > 0),
cut AS (
  SELECT doc_id, a + lead + CAST(coalesce(list_sum(list_transform(parts[1:j - 1], lambda x: length(x))), 0) AS BIGINT) AS a,
         CASE WHEN j < len(parts) THEN rtrim(parts[j], '=') ELSE parts[j] END AS hit FROM part),
whole AS (SELECT doc_id, a, a + length(hit) AS z, hit FROM cut WHERE length(hit) >= 16),
runs AS (
  SELECT f.doc_id, f.a, f.z, f.hit, CASE
    WHEN regexp_matches(hit, '^([0-9a-f]+|[0-9A-F]+)$') AND regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[a-fA-F]') THEN 'hex'
    WHEN regexp_matches(hit, '^[A-Z2-7]+=*$') AND regexp_matches(hit, '[2-7]') AND regexp_matches(hit, '[A-Z]') THEN 'base32'
    WHEN regexp_matches(hit, '^([0-9a-z]+|[0-9A-Z]+)$') AND regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[a-zA-Z]') THEN 'base36'
    WHEN regexp_matches(hit, '^[A-Za-z0-9+/_-]+=*$') AND regexp_matches(hit, '[a-z]') AND regexp_matches(hit, '[A-Z]')
         AND (regexp_matches(hit, '[0-9]') OR regexp_matches(hit, '[a-z][A-Z]')) THEN 'base64'
    WHEN regexp_matches(hit, '^([0-9a-f]+(-[0-9a-f]+)+|[0-9A-F]+(-[0-9A-F]+)+)$') AND regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[a-fA-F]') THEN 'hex_groups'
    WHEN regexp_matches(hit, '^([0-9a-z]+(-[0-9a-z]+)+|[0-9A-Z]+(-[0-9A-Z]+)+)$') AND regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[a-zA-Z]') THEN 'base36_groups'
    END AS encoding
  FROM whole f WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = f.doc_id AND b.a < f.z AND f.a < b.z)),
cand AS (
  SELECT doc_id, a, z, encoding, CASE WHEN encoding LIKE 'hex%' THEN '0123456789abcdef' WHEN encoding = 'base32' THEN 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'
    WHEN encoding LIKE 'base36%' THEN '0123456789abcdefghijklmnopqrstuvwxyz' ELSE 'ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/' END AS alphabet,
    CASE WHEN encoding LIKE 'hex%' OR encoding LIKE 'base36%' THEN lower(replace(hit, '-', '')) ELSE rtrim(translate(hit, '-_=', '+/ ')) END AS token,
    CASE WHEN z - a >= 96 THEN 4 WHEN z - a >= 48 THEN 3 WHEN z - a >= 32 THEN 2 WHEN z - a >= 24 THEN 1 ELSE 0 END AS band
  FROM runs WHERE encoding IS NOT NULL),
c AS (SELECT *, CAST(length(alphabet) AS DOUBLE) AS k, CAST(length(token) AS DOUBLE) AS n FROM cand),
ch AS (
  SELECT doc_id, a, k, n, i, substr(token, i, 1) AS c, CAST(instr(alphabet, substr(token, i, 1)) AS DOUBLE) AS x
  FROM (SELECT *, unnest(range(1, length(token) + 1)) AS i FROM c)),
sq AS (SELECT doc_id, a, sum(m * m) AS squares FROM (SELECT doc_id, a, c, CAST(count(*) AS DOUBLE) AS m FROM ch GROUP BY doc_id, a, c) GROUP BY doc_id, a),
nb AS (
  SELECT *, CASE WHEN x > k / 2 THEN 1.0 ELSE 0.0 END AS up, avg(x) OVER (PARTITION BY doc_id, a) AS mean,
         lag(x) OVER (PARTITION BY doc_id, a ORDER BY i) AS px FROM ch),
st AS (
  SELECT doc_id, a, any_value(k) AS k, any_value(n) AS n, sum(up) AS ones,
         sum(CASE WHEN px IS NOT NULL THEN abs(up - CASE WHEN px > k / 2 THEN 1.0 ELSE 0.0 END) ELSE 0 END) AS turns,
         sum((x - mean) * (x - mean)) AS square, sum(CASE WHEN px IS NOT NULL THEN (x - mean) * (px - mean) ELSE 0 END) AS product
  FROM nb GROUP BY doc_id, a),
zs AS (
  SELECT doc_id, a, (cbrt(greatest(k / n * squares - n, 0) / (k - 1)) - (1 - 2 / (9 * (k - 1)))) / sqrt(2 / (9 * (k - 1))) AS z1,
         abs(turns - 2 * ones * (n - ones) / n) / sqrt(greatest(2 * ones * (n - ones) / n * (2 * ones * (n - ones) / n - 1) / (n - 1), 1e-9)) AS z2,
         abs(product / greatest(square, 1e-9)) * sqrt(n) AS z3
  FROM st JOIN sq USING (doc_id, a)),
cl AS (SELECT doc_id, a, greatest(least(z1, 12), -12) AS z1, greatest(least(z2, 12), -12) AS z2, greatest(least(z3, 12), -12) AS z3 FROM zs),
pv AS (
  SELECT doc_id, a, least(1.0, 3 * least(1 / (1 + exp(1.5976 * z1 + 0.07056 * z1 * z1 * z1)),
    2 / (1 + exp(1.5976 * z2 + 0.07056 * z2 * z2 * z2)), 2 / (1 + exp(1.5976 * z3 + 0.07056 * z3 * z3 * z3)))) AS p FROM cl),
tested AS (SELECT c.doc_id, c.a, c.z, c.encoding, c.band, pv.p FROM c JOIN pv USING (doc_id, a)),
bins AS (SELECT encoding, band, CAST(least(floor(p * 20), 19) AS INTEGER) AS bin, count(*) AS m FROM tested GROUP BY ALL),
tot AS (
  SELECT encoding, band, sum(m) AS m, least(1.0, coalesce(sum(m) FILTER (WHERE bin >= 4), 0) / 0.8 / sum(m)) * sum(m) AS random
  FROM bins GROUP BY encoding, band),
above AS (
  SELECT g.encoding, g.band, g.random, e.cut, coalesce((SELECT sum(m) FROM bins b WHERE b.encoding = g.encoding AND b.band = g.band AND b.bin >= e.cut), 0) AS over
  FROM tot g, range(0, 20) e(cut)),
cuts AS (SELECT encoding, band, min(cut) / 20.0 AS cut FROM above
  WHERE over > 0 AND 1 - least(1.0, random * (1 - cut / 20.0) / over) <= 0.1 GROUP BY encoding, band),
spans AS (
  SELECT doc_id, kind, a, z FROM base
  UNION ALL SELECT doc_id, 3, a, z FROM tested JOIN cuts USING (encoding, band) WHERE p >= cut),
txt AS (SELECT *, (['assign', 'access', 'hex', 'random'])[kind + 1] || ':' || a || ':' || z AS one FROM spans),
agg AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex,
         string_agg(one, ',' ORDER BY a, kind, z) FILTER (WHERE kind < 3) AS b, string_agg(one, ',' ORDER BY a, kind, z) AS spans
  FROM txt GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN agg USING (doc_id)
""")
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    counts = [secrets.of_kind(F.col("spans"), kind).alias(f"n_{kind}") for kind in secrets.BASE]
    base = F.filter("spans", lambda s: s["kind"] < len(secrets.BASE))
    return found.select(
        "doc_id", *counts, F.sha2(secrets.digest(base), 256).alias("base_sha256"), secrets.digest(F.col("spans")).alias("spans"))


@_query("op2_url_filter")
def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(_table(spark, sf_dir, "pages"), URL_RULES)


@_query("op4_source_mixing")
def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.draws(_table(spark, sf_dir, "documents"), entropy=0.9, repetitions=4.0)


@_query("op5_quality_classifier")
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_scan.token_counts(_table(spark, sf_dir, "documents"), TOKENIZER, END_OF_TEXT, id_bytes=2)


@_query("op10_hamming_top_k", """
WITH c AS (SELECT vec_id, list_transform(embedding, lambda x: x > 0) AS code FROM embeddings),
d AS (
  SELECT q.vec_id, v.vec_id AS neighbor_id,
         CAST(len(list_filter(range(1, 65), lambda i: q.code[i] <> v.code[i])) AS INTEGER) AS distance
  FROM c q JOIN c v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank FROM d)
SELECT vec_id, rank, neighbor_id, distance FROM r WHERE rank <= 10
""")
def op10_hamming_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return hamming_search.search(vectors, vectors.filter("vec_id % 20 = 0"), k=10, bits=64, segments=4)


@_query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = conversation_repair.damaged(_table(spark, sf_dir, "conversations"))
    return conversation_repair.repaired(turns, conv_col="conv", gone="gone").withColumnRenamed("conv", "conv_id")


@_query("op13_substring_dedup", r"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT rid, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
  FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM w WHERE len(w) >= 35)),
d AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY h) AS c FROM s) WHERE c > 1),
gone AS (SELECT DISTINCT rid, i + o AS j FROM d, range(0, 35) r(o)),
kept AS (
  SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS kept
  FROM (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM w) ANTI JOIN gone USING (rid, j) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (rid)
""")
def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.without_duplicates(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_query("op11_phrase_collocations", r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM w, range(1, 5) t(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY lang, k, phrase HAVING count(*) >= 30),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cut AS (
  SELECT lang, phrase, a, j, array_to_string(w[1:j], ' ') AS head, array_to_string(w[j + 1:], ' ') AS tail
  FROM c, range(1, 4) t(j) WHERE j < k),
s AS (
  SELECT cut.lang, cut.phrase, cut.a, j, x.a AS l, y.a AS r, (CAST(cut.a AS HUGEINT) * 2000000) // (CAST(x.a AS HUGEINT) + y.a) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = head JOIN f y ON y.lang = cut.lang AND y.phrase = tail),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS place FROM s),
longer AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS a
  FROM c, range(2, 4) t(m), range(1, 4) u(i) WHERE m < k AND i + m - 1 <= k GROUP BY ALL),
lone AS (
  SELECT b.* FROM best b LEFT JOIN longer o USING (lang, phrase) WHERE place = 1 AND (o.a IS NULL OR 100 * o.a < 80 * b.a)),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM lone)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM r JOIN n USING (lang) WHERE rank <= 2000
""")
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))
