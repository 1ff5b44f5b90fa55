"""Splits, imputers, scalers, encoders, clipping, clustering and rebalancing."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import CLEANED, DIRTY, dirty, query, raw_admissions, table
from tallyloom.operators import clip, iterative, kmodes, neighbors, resample, split
from tallyloom.operators.prepare import (
    Categorical, Constant, Mean, Median, MinMaxScale, MostFrequent, NoScale, Numeric, OneHot, Ordinal, Preprocessor,
    StandardScale,
)
from tallyloom.plans.cleaning import admissions_plan
from tallyloom.streaming.replay import drain


def rounded(df, *columns, digits=6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# splits -------------------------------------------------------------------------------------------------------------

_HASH = "substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 13)"
_PLACE = _HASH.format(key="o_orderkey", seed=42)


@query("split_dataset", sql=f"""
SELECT o_orderkey, o_orderstatus, CASE WHEN row_number() OVER (ORDER BY {_PLACE}) <= ceil(0.2 * count(*) OVER ()) THEN 'test'
       ELSE 'train' END AS split FROM orders
""")
def split_dataset(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.with_split(rows, ["o_orderkey"], 0.2)


@query("split_stratified", sql=f"""
WITH c AS (SELECT o_orderstatus AS s, count(*) AS n, ceil(0.2 * sum(count(*)) OVER ()) AS total, sum(count(*)) OVER () AS m FROM orders GROUP BY 1),
q AS (SELECT s, floor(total * n / m) AS whole, total * n / m - floor(total * n / m) AS part, total FROM c),
k AS (SELECT s, whole + CASE WHEN row_number() OVER (ORDER BY part DESC, s) <= total - sum(whole) OVER () THEN 1 ELSE 0 END AS quota FROM q)
SELECT o_orderkey, o_orderstatus,
       CASE WHEN row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_PLACE}) <= quota THEN 'test' ELSE 'train' END AS split
FROM orders JOIN k ON o_orderstatus = s
""")
def split_stratified(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.with_split(rows, ["o_orderkey"], 0.2, stratify="o_orderstatus")


@query("split_then_stack", sql=f"""
SELECT split, CAST(count(*) AS BIGINT) AS n, CAST(sum(o_custkey) AS BIGINT) AS customers FROM (
  SELECT o_custkey, CASE WHEN row_number() OVER (ORDER BY {_PLACE}) <= ceil(0.3 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
  FROM orders) GROUP BY 1
""")
def split_then_stack(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    train, test = split.split_dataset(rows, "o_orderstatus", ["o_orderkey"], 0.3)
    return split.stack_splits(train, test).groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("customers"))


@query("join_target", sql="SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def join_target(spark, sf):
    orders = table(spark, sf, "orders")
    return split.join_target(orders.select("o_orderkey", "o_custkey", "o_totalprice"), orders.select("o_orderkey", "o_orderstatus"), ["o_orderkey"])


def _folds(place, partition):
    return f"""
WITH r AS (SELECT o_orderkey, o_orderstatus, row_number() OVER ({partition} ORDER BY {place}) - 1 AS i,
                  count(*) OVER ({partition}) AS n FROM orders)
SELECT o_orderkey, o_orderstatus,
       CAST(CASE WHEN i < (n % 5) * (n // 5 + 1) THEN i // (n // 5 + 1) ELSE n % 5 + (i - (n % 5) * (n // 5 + 1)) // (n // 5) END AS INT) AS fold
FROM r"""


@query("folds", sql=_folds(_PLACE, ""))
def folds(spark, sf):
    return split.with_folds(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), ["o_orderkey"], 5)


@query("folds_stratified", sql=_folds(_PLACE, "PARTITION BY o_orderstatus"))
def folds_stratified(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return split.with_folds(rows, ["o_orderkey"], 5, stratify="o_orderstatus")


# imputers, scalers, encoders ----------------------------------------------------------------------------------------

def _marked(source, key):
    """SQL that marks the train rows of a table: all but the first fifth in hash order of the key."""
    place = f"('0x' || {_HASH.format(key=key, seed=42)})::BIGINT"
    return f""",
placed AS (SELECT *, {place} AS h FROM {source}),
cut AS (SELECT h FROM (SELECT h, row_number() OVER (ORDER BY h) AS i, count(*) OVER () AS n FROM placed) WHERE i = ceil(0.2 * n)),
marked AS (SELECT *, h > (SELECT h FROM cut) AS is_train FROM placed)"""


MARKED = DIRTY + _marked("dirty", "unnamed_0") + "\n"


def _fit_on_train(rows, key, custom):
    """Fit on the train part of a split, apply to all rows."""
    train = split.with_split(rows, [key], 0.2).filter("split = 'train'").drop("split")
    return Preprocessor(custom, keep=[key]).fit(train)


def _fitted(spark, sf, columns, custom):
    rows = dirty(spark, sf).select("unnamed_0", *columns)
    return _fit_on_train(rows, "unnamed_0", custom).transform(rows)


PLAIN = NoScale()


@query("impute_mean_and_median", sql=MARKED + f"""
SELECT unnamed_0, round(coalesce(age, (SELECT avg(age) FROM marked WHERE is_train)), 6) AS age,
       coalesce(comorbidities, (SELECT quantile_cont(comorbidities, 0.5) FROM marked WHERE is_train)) AS comorbidities FROM marked
""")
def impute_mean_and_median(spark, sf):
    out = _fitted(spark, sf, ["age", "comorbidities"], {"age": Numeric(Mean(), PLAIN), "comorbidities": Numeric(Median(), PLAIN)})
    return rounded(out, "age")


@query("impute_most_frequent", sql=MARKED + f"""
SELECT unnamed_0, coalesce(gender, (SELECT gender FROM marked WHERE is_train AND gender IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS gender,
       coalesce(number_of_previous_admissions, (SELECT number_of_previous_admissions FROM marked
         WHERE is_train AND number_of_previous_admissions IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS number_of_previous_admissions
FROM marked
""")
def impute_most_frequent(spark, sf):
    return _fitted(spark, sf, ["gender", "number_of_previous_admissions"], {
        "gender": Categorical(MostFrequent(), None), "number_of_previous_admissions": Numeric(MostFrequent(), PLAIN)})


@query("impute_constant", sql=MARKED + "SELECT unnamed_0, coalesce(gender, 'missing') AS gender, coalesce(age, 0) AS age FROM marked")
def impute_constant(spark, sf):
    return _fitted(spark, sf, ["gender", "age"], {"gender": Categorical(Constant("missing"), None), "age": Numeric(Constant(0), PLAIN)})


@query("scale_standard", sql=MARKED + f""", f AS (SELECT avg(age) AS a, quantile_cont(comorbidities, 0.5) AS m FROM marked WHERE is_train),
t AS (SELECT avg(coalesce(age, a)) AS am, stddev_pop(coalesce(age, a)) AS asd, avg(coalesce(comorbidities, m)) AS cm,
             stddev_pop(coalesce(comorbidities, m)) AS csd FROM marked, f WHERE is_train)
SELECT unnamed_0, round((coalesce(age, a) - am) / asd, 6) AS age, round((coalesce(comorbidities, m) - cm) / csd, 6) AS comorbidities
FROM marked, f, t
""")
def scale_standard(spark, sf):
    out = _fitted(spark, sf, ["age", "comorbidities"], {"comorbidities": Numeric(Median(), StandardScale())})
    return rounded(out, "age", "comorbidities")


@query("scale_min_max", sql=MARKED + f""", f AS (SELECT avg(age) AS a, min(age) AS lo, max(age) AS hi FROM marked WHERE is_train)
SELECT unnamed_0, round((coalesce(age, a) - lo) / (hi - lo), 6) AS age FROM marked, f
""")
def scale_min_max(spark, sf):
    return rounded(_fitted(spark, sf, ["age"], {"age": Numeric(Mean(), MinMaxScale())}), "age")


_ADHERENCE = ["Hig", "High", "Lo", "Low", "Mediu", "Medium"]


@query("encode_one_hot", sql=MARKED + f""", f AS (SELECT medication_adherence AS m FROM marked WHERE is_train AND medication_adherence IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT unnamed_0, {", ".join(f"CAST(coalesce(medication_adherence, m) = '{v}' AS DOUBLE) AS medication_adherence_{v}" for v in _ADHERENCE)} FROM marked, f
""")
def encode_one_hot(spark, sf):
    return _fitted(spark, sf, ["medication_adherence"], {})


@query("encode_one_hot_unseen", sql="""
SELECT c_custkey, CAST(c_mktsegment = 'AUTOMOBILE' AS DOUBLE) AS "c_mktsegment_AUTOMOBILE", CAST(c_mktsegment = 'BUILDING' AS DOUBLE) AS "c_mktsegment_BUILDING"
FROM customer
""")
def encode_one_hot_unseen(spark, sf):
    """Fitted on two segments; the others become zeros."""
    rows = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    train = rows.filter(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING"))
    return Preprocessor(keep=["c_custkey"]).fit(train).transform(rows)


@query("encode_wide_column", sql="""
WITH c AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS i FROM (SELECT DISTINCT p_brand FROM part))
SELECT p_partkey, CAST(i AS INT) AS place, CAST(1 AS DOUBLE) AS weight FROM part JOIN c USING (p_brand)
""")
def encode_wide_column(spark, sf):
    """A column of many categories as one sparse vector, read back as (place, weight)."""
    from pyspark.ml.functions import vector_to_array

    rows = table(spark, sf, "part").select("p_partkey", "p_brand")
    spec = {"p_brand": Categorical(MostFrequent(), OneHot(sparse=True))}
    encoded = Preprocessor(spec, keep=["p_partkey"]).fit(rows).transform(rows)
    return encoded.select("p_partkey", F.posexplode(vector_to_array("p_brand_vec")).alias("place", "weight")).filter("weight <> 0")


@query("encode_ordinal", sql="""
SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY p_type) - 1 AS DOUBLE) AS p_type FROM part
""")
def encode_ordinal(spark, sf):
    rows = table(spark, sf, "part").select("p_partkey", "p_type")
    return Preprocessor({"p_type": Categorical(MostFrequent(), Ordinal())}, keep=["p_partkey"]).fit(rows).transform(rows)


@query("encode_ordinal_wide", sql="""
SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS DOUBLE) AS c_name FROM customer
""")
def encode_ordinal_wide(spark, sf):
    """A category of its own for every row."""
    rows = table(spark, sf, "customer").select("c_custkey", "c_name")
    return Preprocessor({"c_name": Categorical(MostFrequent(), Ordinal())}, keep=["c_custkey"]).fit(rows).transform(rows)


@query("workflow_features", sql="""
WITH names AS (
  SELECT 1 AS part, 'o_totalprice' AS feature
  UNION ALL SELECT DISTINCT 2, 'o_orderpriority_' || o_orderpriority FROM orders
  UNION ALL SELECT 3, 'year' UNION ALL SELECT 4, 'open')
SELECT CAST(row_number() OVER (ORDER BY part, feature) - 1 AS INT) AS place, feature FROM names
""")
def workflow_features(spark, sf):
    """What models are given: treated columns, then the integer and boolean columns that pass through."""
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("double").alias("o_totalprice"), "o_orderpriority",
        F.year("o_orderdate").alias("year"), (F.col("o_orderstatus") == "O").alias("open"))
    names = Preprocessor(keep=["o_orderkey"]).fit(rows).feature_names
    return spark.createDataFrame(list(enumerate(names)), "place int, feature string")


_ROUTED = CLEANED + _marked("cleaned", "id") + """,
t AS (SELECT avg(age) AS am, stddev_pop(age) AS asd, min(length_of_stay) AS lo, max(length_of_stay) AS hi,
             avg(comorbidities) AS cm, stddev_pop(comorbidities) AS csd, avg(number_of_previous_admissions) AS nm,
             stddev_pop(number_of_previous_admissions) AS nsd FROM marked WHERE is_train)
SELECT id, round((CAST(length_of_stay AS DOUBLE) - lo) / (hi - lo), 6) AS length_of_stay, round((age - am) / asd, 6) AS age,
       round((comorbidities - cm) / csd, 6) AS comorbidities, round((number_of_previous_admissions - nm) / nsd, 6) AS number_of_previous_admissions,
       CAST(CASE medication_adherence WHEN 'High' THEN 0 WHEN 'Low' THEN 1 ELSE 2 END AS DOUBLE) AS medication_adherence,
       CAST(gender = 'Female' AS DOUBLE) AS "gender_Female", CAST(gender = 'Male' AS DOUBLE) AS "gender_Male",
       CAST(smoking_status = ' no' AS DOUBLE) AS "smoking_status_ no", CAST(smoking_status = 'No' AS DOUBLE) AS "smoking_status_No",
       CAST(smoking_status = 'Yes' AS DOUBLE) AS "smoking_status_Yes", risk_category
FROM marked, t
"""


def routed_frame(spark, sf):
    raw = dirty(spark, sf).withColumn("id", F.col("unnamed_0"))
    return admissions_plan().clean_all(raw).drop("socioeconomic_status")


ROUTED = {"length_of_stay": Numeric(Mean(), MinMaxScale()), "medication_adherence": Categorical(MostFrequent(), Ordinal())}


@query("preprocess_routed", sql=_ROUTED)
def preprocess_routed(spark, sf):
    """Custom treatment for two columns, defaults for the rest, key and label passed through."""
    rows = routed_frame(spark, sf)
    out = _fit_on_train(rows, "id", ROUTED).transform(rows)
    return rounded(out, "length_of_stay", "age", "comorbidities", "number_of_previous_admissions")


@query("preprocess_stream", sql=_ROUTED)
def preprocess_stream(spark, sf):
    """The fitted transform applied to a stream of the same rows."""
    rows = routed_frame(spark, sf)
    fitted = _fit_on_train(rows, "id", ROUTED)
    out = drain(rows, fitted.transform)
    return rounded(out, "length_of_stay", "age", "comorbidities", "number_of_previous_admissions")


@query("clean_stream", sql=DIRTY + """
SELECT unnamed_0, age, coalesce(gender, 'missing') AS gender, lower(smoking_status) AS smoking_status,
       CASE medication_adherence WHEN 'Lo' THEN 'Low' WHEN 'Mediu' THEN 'Medium' WHEN 'Hig' THEN 'High' ELSE medication_adherence END AS medication_adherence
FROM dirty WHERE age IS NOT NULL AND age BETWEEN 0 AND 105
""")
def clean_stream(spark, sf):
    """A chain of cleaning steps on a stream."""
    from tallyloom.operators import clean
    from tallyloom.operators.steps import run_steps

    rows = dirty(spark, sf).select("unnamed_0", "age", "gender", "smoking_status", "medication_adherence")
    steps = [
        clean.drop_missing_step(["age"]), clean.out_of_range_step("age", 0, 105), clean.mark_missing_step((), ["gender"]),
        clean.lowercase_step(["smoking_status"]),
        clean.map_values_step({"medication_adherence": {"Lo": "Low", "Mediu": "Medium", "Hig": "High"}}),
    ]
    return drain(rows, lambda df: run_steps(df, steps))


# clipping -----------------------------------------------------------------------------------------------------------

def _clip(low, high, stats, column="value", source="events", key="event_id"):
    value = f"greatest({column}, {low})" if low else column
    value = f"least({value}, {high})" if high else value
    return f"WITH s AS (SELECT {stats} FROM {source}) SELECT {key}, round({value}, 6) AS {column} FROM {source}, s"


def _clipped(spark, sf, clipper):
    rows = table(spark, sf, "events").select("event_id", "value")
    return rounded(clipper.fit_transform(rows, ["value"]), "value")


@query("clip_zscore", sql=_clip("a - 2 * d", "a + 2 * d", "avg(value) AS a, stddev_samp(value) AS d"))
def clip_zscore(spark, sf):
    return _clipped(spark, sf, clip.OutlierClipper("zscore", 2.0))


@query("clip_iqr", sql=_clip("q1 - 1.5 * (q3 - q1)", "q3 + 1.5 * (q3 - q1)",
                             "quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3"))
def clip_iqr(spark, sf):
    return _clipped(spark, sf, clip.OutlierClipper("iqr", 1.5))


@query("clip_quantile_top", sql=_clip(None, "q", "quantile_cont(value, 0.95) AS q"))
def clip_quantile_top(spark, sf):
    return _clipped(spark, sf, clip.OutlierClipper("quantile", 0.95))


@query("clip_quantile_bottom", sql=_clip("q", None, "quantile_cont(value, 0.1) AS q"))
def clip_quantile_bottom(spark, sf):
    return _clipped(spark, sf, clip.OutlierClipper("quantile", 0.1))


@query("clip_mad", sql="""
WITH m AS (SELECT quantile_cont(value, 0.5) AS m FROM events), d AS (SELECT quantile_cont(abs(value - m), 0.5) AS d FROM events, m)
SELECT event_id, round(least(greatest(value, m - 3 * d), m + 3 * d), 6) AS value FROM events, m, d
""")
def clip_mad(spark, sf):
    return _clipped(spark, sf, clip.OutlierClipper("mad", 3.0))


@query("clip_domain", sql="SELECT c_custkey, least(greatest(c_acctbal, 0), 5000) AS c_acctbal FROM customer")
def clip_domain(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return clip.OutlierClipper("domain", domain_limits={"c_acctbal": (0, 5000)}).fit_transform(rows)


# clustering ---------------------------------------------------------------------------------------------------------

@query("kmodes_few_combinations", sql=DIRTY + """
SELECT unnamed_0, CAST(dense_rank() OVER (ORDER BY coalesce(gender, '__missing__'), smoking_status) - 1 AS INT) AS cluster FROM dirty
""")
def kmodes_few_combinations(spark, sf):
    """No more combinations than clusters: every combination is its own cluster, in sorted order."""
    rows = dirty(spark, sf).select("unnamed_0", "gender", "smoking_status")
    return kmodes.KModes(9).fit(rows, ["gender", "smoking_status"]).transform(rows).select("unnamed_0", "cluster")


def _kmodes(init):
    def run(spark, sf):
        columns = ["gender", "medication_adherence", "socioeconomic_status", "smoking_status"]
        rows = dirty(spark, sf).select("unnamed_0", *columns)
        model = kmodes.KModes(5, init, n_init=2).fit(rows, columns)
        return model.transform(rows).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))

    return run


query("kmodes_cao")(_kmodes("Cao"))
query("kmodes_huang")(_kmodes("Huang"))


@query("impute_kmodes", sql=DIRTY + """,
c AS (SELECT *, coalesce(gender, '__missing__') || '|' || smoking_status AS k, nullif(socioeconomic_status, 'unknown') AS known FROM dirty),
m AS (SELECT k, known, row_number() OVER (PARTITION BY k ORDER BY count(*) DESC, known) AS rn FROM c WHERE known IS NOT NULL GROUP BY 1, 2)
SELECT unnamed_0, coalesce(c.known, m.known, 'unknown') AS socioeconomic_status FROM c LEFT JOIN m ON c.k = m.k AND rn = 1
""")
def impute_kmodes(spark, sf):
    rows = dirty(spark, sf).select("unnamed_0", "gender", "smoking_status", "socioeconomic_status")
    fitted = kmodes.KModesImputer(["gender", "smoking_status"], n_clusters=9).fit(rows, "socioeconomic_status")
    return fitted.transform(rows).select("unnamed_0", "socioeconomic_status")


# neighbours ---------------------------------------------------------------------------------------------------------

# A vector per customer with gaps, equal in both engines; coordinates are small whole numbers, so that
# sums of squares are exact and equal distances are equal in both.
_GAPPED = """
SELECT c_custkey, CAST(CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_nationkey END AS DOUBLE) AS a,
       CAST(CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE floor(c_acctbal / 500) END AS DOUBLE) AS b,
       CAST(CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_custkey * 7919 % 31 END AS DOUBLE) AS c
FROM customer
"""


def _gapped(spark, sf):
    return spark.sql(_GAPPED.replace("FROM customer", "FROM {customer}"), customer=table(spark, sf, "customer"))


def _knn_column(c):
    shared = [f"(q.{x} IS NOT NULL AND d.{x} IS NOT NULL)" for x in "abc"]
    total = " + ".join(f"coalesce((q.{x} - d.{x}) * (q.{x} - d.{x}), 0)" for x in "abc")
    count = " + ".join(f"CAST({s} AS INT)" for s in shared)
    return f"""
n{c} AS (SELECT q.c_custkey, avg(v) AS v FROM g q JOIN (
  SELECT q.c_custkey AS k, d.{c} AS v, row_number() OVER (PARTITION BY q.c_custkey
           ORDER BY sqrt(({total}) * (3.0 / ({count}))), d.c_custkey) AS rn
  FROM g q JOIN g d ON q.{c} IS NULL AND d.{c} IS NOT NULL AND ({" OR ".join(shared)})) ON k = q.c_custkey AND rn <= 5 GROUP BY 1)"""


@query("impute_knn", sql=f"WITH g AS ({_GAPPED})," + ",".join(_knn_column(c) for c in "abc") + """
SELECT g.c_custkey, """ + ", ".join(f"round(coalesce(g.{c}, n{c}.v, (SELECT avg({c}) FROM g)), 6) AS {c}" for c in "abc") + """
FROM g LEFT JOIN na ON na.c_custkey = g.c_custkey LEFT JOIN nb ON nb.c_custkey = g.c_custkey LEFT JOIN nc ON nc.c_custkey = g.c_custkey
""")
def impute_knn(spark, sf):
    rows = _gapped(spark, sf)
    return rounded(neighbors.KNNImputer(5).fit(rows, ["a", "b", "c"], "c_custkey").transform(rows), "a", "b", "c")


@query("impute_iterative_cells", sql=f"WITH g AS ({_GAPPED})" + "\nUNION ALL ".join(
    f" SELECT c_custkey, '{c}' AS \"column\", {c} AS observed, TRUE AS filled FROM g" for c in "abc"))
def impute_iterative_cells(spark, sf):
    """Observed cells stay as they are, and no gap is left."""
    rows = _gapped(spark, sf)
    out = iterative.IterativeImputer(max_iter=3).fit_transform(rows, ["a", "b", "c"])
    both = rows.join(out.select("c_custkey", *[F.col(c).alias(f"new_{c}") for c in "abc"]), "c_custkey")
    cells = [F.struct(F.lit(c).alias("column"), F.when(F.col(c).isNotNull(), F.col(f"new_{c}")).alias("observed"),
                      F.col(f"new_{c}").isNotNull().alias("filled")) for c in "abc"]
    return both.select("c_custkey", F.inline(F.array(*cells)))


@query("preprocess_routed_knn", sql=f"WITH g AS ({_GAPPED})," + ",".join(_knn_column(c) for c in "abc") + """,
f AS (
  SELECT g.c_custkey, """ + ", ".join(f"coalesce(g.{c}, n{c}.v, (SELECT avg({c}) FROM g)) AS {c}" for c in "abc") + """
  FROM g LEFT JOIN na ON na.c_custkey = g.c_custkey LEFT JOIN nb ON nb.c_custkey = g.c_custkey LEFT JOIN nc ON nc.c_custkey = g.c_custkey)
SELECT c_custkey, round((a - avg(a) OVER ()) / stddev_pop(a) OVER (), 6) + 0.0 AS a, round((b - min(b) OVER ()) / (max(b) OVER () - min(b) OVER ()), 6) AS b,
       round(c, 6) AS c FROM f
""")
def preprocess_routed_knn(spark, sf):
    """Three columns imputed together by their nearest rows, each with its own scaler."""
    near = neighbors.KNNImputer(5)
    spec = {"a": Numeric(near, StandardScale()), "b": Numeric(near, MinMaxScale()), "c": Numeric(near, NoScale())}
    rows = _gapped(spark, sf)
    out = Preprocessor(spec, key="c_custkey").fit(rows).transform(rows)
    return rounded(out, "a", "b", "c").withColumn("a", F.col("a") + F.lit(0.0))


@query("impute_iterative")
def impute_iterative(spark, sf):
    """Bayesian ridge rounds have no SQL form; a unit test holds them against array arithmetic."""
    rows = _gapped(spark, sf)
    return rounded(iterative.IterativeImputer(max_iter=3).fit_transform(rows, ["a", "b", "c"]), "a", "b", "c")


_LABELLED = """
SELECT doc_id, quality, CAST(length(text) % 50 AS DOUBLE) AS x, CAST(n_chars % 37 AS DOUBLE) AS y, CAST(doc_id % 23 AS DOUBLE) AS z
FROM documents JOIN labels USING (doc_id)
"""


def labelled(spark, sf):
    return spark.sql(_LABELLED.replace("FROM documents JOIN labels", "FROM {documents} JOIN {labels}"),
                     documents=table(spark, sf, "documents"), labels=table(spark, sf, "labels"))


FEATURES = ["x", "y", "z"]


@query("smote_class_counts", sql=f"""
WITH l AS ({_LABELLED}), n AS (SELECT quality, count(*) AS n FROM l GROUP BY 1), m AS (SELECT max(n) AS m FROM n)
SELECT quality, synthetic, CAST(CASE WHEN synthetic THEN m - n ELSE n END AS BIGINT) AS n
FROM n, m, (VALUES (TRUE), (FALSE)) v(synthetic) WHERE NOT synthetic OR m > n
""")
def smote_class_counts(spark, sf):
    grown = resample.smote(labelled(spark, sf), "quality", FEATURES, "doc_id")
    return grown.groupBy("quality", "synthetic").agg(F.count(F.lit(1)).alias("n"))


@query("smote")
def smote(spark, sf):
    return resample.smote(labelled(spark, sf), "quality", FEATURES, "doc_id")


@query("edited_nearest_neighbours", sql=f"""
WITH l AS ({_LABELLED}), m AS (SELECT quality AS big FROM l GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
n AS (SELECT a.doc_id, b.quality, row_number() OVER (PARTITION BY a.doc_id
        ORDER BY (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z), b.doc_id) AS rn
      FROM l a JOIN l b ON a.doc_id <> b.doc_id JOIN m ON a.quality = big),
v AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY doc_id ORDER BY count(*) DESC, quality) AS rn FROM n WHERE rn <= 5 GROUP BY 1, 2)
SELECT l.* FROM l WHERE quality <> (SELECT big FROM m) OR doc_id IN (SELECT doc_id FROM v WHERE rn = 1 AND quality = (SELECT big FROM m))
""")
def edited_nearest_neighbours(spark, sf):
    return resample.edited_nearest_neighbours(labelled(spark, sf), "quality", FEATURES, "doc_id")


@query("smote_enn")
def smote_enn(spark, sf):
    return resample.smote_enn(labelled(spark, sf), "quality", FEATURES, "doc_id")
