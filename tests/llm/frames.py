"""Small input tables; every one carries further columns with names that operators use themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

CLASHING = (
    "id run digest check size points best members keep node n low high bands bucket pivot label a b u v rank bucket_place "
    "length piece start crc offset tokens source_tokens plan epoch block place evidence site score accepted held_out verdict "
    "rule spans base candidates code query distance vector ids file bytes ends _tl"
).split()


def documents(spark, rows):
    """Rows (doc_id, text, source, lang), or shorter ones, as `documents`."""
    full = [(tuple(r) + (None, "src", "en")[len(r) - 1 :])[:4] for r in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, source string, lang string")
    return df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASHING)])


def collected(df, key="doc_id"):
    """{key: row}, of rows with different keys."""
    rows = df.collect()
    out = {r[key]: r for r in rows}
    assert len(out) == len(rows)
    return out
