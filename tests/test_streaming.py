from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyloom.streaming import stateful

SCHEMA = "id long, ts timestamp, x double, t string"


def rows(spark, *items):
    day = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(i, None if h is None else day + dt.timedelta(hours=h), x, t) for i, h, x, t in items], SCHEMA)


def profiled(frame):
    return sorted(((r["window_start"].hour, r["column"], r["rows"], r["missing"], r["mean"]) for r in frame.collect()), key=str)


def test_stream_gives_what_a_frame_gives(spark):
    first = rows(spark, (1, 0, 1.0, "a"), (2, 0.5, None, None), (3, 1.5, 4.0, "b"), (4, None, 9.0, "z"))
    second = rows(spark, (5, 2.5, 6.0, None), (6, 2.6, None, "c"))

    def profile(df):
        return stateful.windowed_profile(df, "ts", "1 hour", ["x", "t"], delay="10 minutes")

    both = first.unionByName(second)
    want = profiled(profile(both))
    assert profiled(stateful.replay([first, second, stateful.heartbeat(both, "ts", "2 hours")], profile)) == want
    assert want == [(0, "t", 2, 1, None), (0, "x", 2, 1, 1.0), (1, "t", 1, 0, None), (1, "x", 1, 0, 4.0), (2, "t", 2, 1, None), (2, "x", 2, 1, 6.0)]


def test_late_rows_are_dropped(spark):
    parts = [rows(spark, (1, 1, 1.0, "a"), (2, 9, 1.0, "a")), rows(spark, (3, 1.2, 5.0, "late"), (4, 9.1, 3.0, "a"))]
    parts.append(stateful.heartbeat(parts[1], "ts", "5 hours"))
    found = profiled(stateful.replay(parts, lambda s: stateful.windowed_profile(s, "ts", "1 hour", ["x"], delay="1 hour")))
    assert found == [(1, "x", 1, 0, 1.0), (9, "x", 2, 0, 2.0)]


def test_sliding_windows_and_missing_delay(spark):
    frame = rows(spark, (1, 1.25, 2.0, "a"))
    assert [r[0] for r in profiled(stateful.windowed_profile(frame, "ts", "1 hour", ["x"], slide="30 minutes"))] == [0, 1]
    with pytest.raises(ValueError, match="delay"):
        stateful.replay([frame], lambda s: stateful.windowed_profile(s, "ts", "1 hour", ["x"]))


def test_repeats_are_dropped_within_the_delay_and_forgotten_after_it(spark):
    parts = [
        rows(spark, (1, 1, 1.0, "a"), (2, 1.1, 1.0, "a"), (None, 1.1, 1.0, "n")),
        rows(spark, (1, 1.4, 2.0, "again"), (None, 1.2, 1.0, "n")), rows(spark, (7, 6, 1.0, "a")), rows(spark, (8, 8, 1.0, "a")),
        rows(spark, (1, 8.5, 3.0, "new")),
    ]
    kept = stateful.replay(parts, lambda s: stateful.drop_repeats(s, ["id"], "ts", "1 hour"))
    assert sorted((r["id"] or 0, r["x"]) for r in kept.collect()) == [(0, 1.0), (1, 1.0), (1, 3.0), (2, 1.0), (7, 1.0), (8, 1.0)]


def test_state_stays_within_the_delay(spark):
    """Keys of past hours leave the state."""
    from tallyloom.session import scratch_path

    path, state = scratch_path(spark, "in"), scratch_path(spark, "state")
    sizes = []
    for hour in range(5):
        rows(spark, *[(100 * hour + i, hour * 3, 0.0, "a") for i in range(50)]).write.mode("append").parquet(path)
        stream = stateful.drop_repeats(spark.readStream.schema(SCHEMA).parquet(path), ["id"], "ts", "1 hour")
        run = stream.writeStream.format("noop").option("checkpointLocation", state).trigger(availableNow=True).start()
        run.awaitTermination()
        sizes.append(run.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert max(sizes) <= 100


def test_heartbeat_has_the_columns_of_its_frame(spark):
    frame = rows(spark, (1, 1, 1.0, "a"))
    beat = stateful.heartbeat(frame, "ts", "2 hours")
    assert beat.schema.simpleString() == frame.schema.simpleString()
    assert beat.select(F.hour("ts")).first()[0] == 3
