"""Operators with state on streams, and the same on frames."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, table
from tallyloom.streaming import stateful

WIDTH, DELAY = "6 hours", "1 hour"
PROFILED = ["user_id", "event_type", "value"]
WINDOWS = """
WITH e AS (
  SELECT ts, user_id, nullif(event_type, 'error') AS event_type, CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events),
w AS (SELECT *, time_bucket(INTERVAL '6 hours', CAST(ts AS TIMESTAMP), TIMESTAMP '1970-01-01') AS s FROM e)
""" + "\nUNION ALL ".join(f"""
SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(s + INTERVAL '6 hours', '%Y-%m-%d %H:%M:%S') AS window_end,
       '{c}' AS "column", count(*) AS "rows", count(*) - count({c}) AS missing, {m} AS mean FROM w GROUP BY s"""
    for c, m in (("user_id", "round(avg(user_id), 6)"), ("event_type", "CAST(NULL AS DOUBLE)"), ("value", "round(avg(value), 6)")))


def gapped_events(spark, sf):
    events = table(spark, sf, "events")
    return events.select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", F.nullif(F.col("event_type"), F.lit("error")).alias("event_type"),
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"))


def shown(profile):
    def text(c):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)

    return profile.select(text("window_start"), text("window_end"), "column", "rows", "missing", F.round("mean", 6).alias("mean"))


@query("windowed_profile", sql=WINDOWS)
def windowed_profile(spark, sf):
    return shown(stateful.windowed_profile(gapped_events(spark, sf), "ts", WIDTH, PROFILED))


@query("windowed_profile_stream", sql=WINDOWS)
def windowed_profile_stream(spark, sf):
    """The events as they come in, two runs, and a heartbeat that closes the last window."""
    events = gapped_events(spark, sf)
    middle = events.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    at = F.lit(middle["low"] + (middle["high"] - middle["low"]) / 2)
    parts = [events.filter(F.col("ts") < at), events.filter(F.col("ts") >= at), stateful.heartbeat(events, "ts", "8 hours")]
    return shown(stateful.replay(parts, lambda s: stateful.windowed_profile(s, "ts", WIDTH, PROFILED, delay=DELAY)))


# Every fifth event is sent again ten minutes later, within the delay. Those of the first quarter of the time whose
# number is a multiple of 30 come again in the last quarter, when they are forgotten.
@query("stream_deduplicate", sql="""
WITH span AS (SELECT epoch_us(min(ts)) AS low, epoch_us(max(ts)) AS high FROM events),
q AS (SELECT e.*, least((epoch_us(ts) - low) * 4 // (high - low + 1), 3) AS part FROM events e, span)
SELECT event_id, user_id, event_type, value FROM q
UNION ALL SELECT event_id, user_id, event_type, value FROM q WHERE part = 0 AND event_id % 30 = 0
""")
def stream_deduplicate(spark, sf):
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    ends = events.agg(F.min(F.unix_micros("ts")).alias("low"), F.max(F.unix_micros("ts")).alias("high")).first()
    span = ends["high"] - ends["low"] + 1
    part = F.floor((F.unix_micros("ts") - F.lit(ends["low"])) * 4 / F.lit(span)).cast("int")
    own = events.withColumn("part", F.least(part, F.lit(3)))
    again = own.filter("event_id % 5 = 0").withColumn("ts", F.col("ts") + F.expr("INTERVAL 10 MINUTES"))
    late = own.filter("part = 0 AND event_id % 30 = 0").select(
        "event_id", F.timestamp_micros(F.lit(ends["high"])).alias("ts"), "user_id", "event_type", "value", F.lit(3).alias("part"))
    every = own.unionByName(again).unionByName(late)
    parts = [every.filter(F.col("part") == i).drop("part") for i in range(4)]
    kept = stateful.replay(parts, lambda s: stateful.drop_repeats(s, ["event_id"], "ts", DELAY))
    return kept.select("event_id", "user_id", "event_type", "value")
