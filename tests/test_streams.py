"""Streams over folders of part files: nothing is lost, whatever order the rows come in."""

import datetime as dt
import random

from pyspark.sql import functions as F

from granary.streaming import windows


def _parts(spark, folder):
    draw = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(minutes=draw.randrange(5000)), i % 7, "ab"[i % 2], float(i)) for i in range(400)]
    schema = "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, value DOUBLE"
    rows.sort(key=lambda r: r[1], reverse=True)
    for part in (rows[:150], rows[150:]):  # the late hours come first
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{folder}/events.parquet")
    return spark.read.parquet(f"{folder}/events.parquet")


def test_windows_and_sessions_of_part_files(spark, tmp_path):
    events = _parts(spark, str(tmp_path))
    assert events.count() == 400
    stream = windows.event_stream(spark, str(tmp_path), "events")
    got = windows.run_closed(stream, lambda e: windows.windowed_summary(e, "6 hours", "10 minutes"))
    want = events.groupBy(F.window(F.col("ts").cast("timestamp"), "6 hours"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.avg("value"))
    assert sorted(map(str, got.collect())) == sorted(str(r).replace("avg(value)", "mean") for r in want.select(F.col("window.start").alias("window_start"), "event_type", "n", "avg(value)").collect())
    sessions = windows.run_closed(windows.event_stream(spark, str(tmp_path), "events"), lambda e: windows.session_summary(e, "3 hours", "10 minutes"))
    assert sessions.agg(F.sum("n")).first()[0] == 400
