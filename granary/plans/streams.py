"""Streaming forms of two batch operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.plans.aggregates import rounded
from granary.plans.registry import fx, query
from granary.streaming import windows


@query(
    "x01_window_summary",
    f"""WITH w AS (SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') AS s, event_type, count(*) AS n, {fx("avg(value)")} AS mean FROM events GROUP BY 1, 2)
SELECT s AS window_start, event_type, n, mean FROM w""",
)
def x01_window_summary(spark, sf):
    out = windows.run_closed(windows.event_stream(spark, sf, "events"), lambda e: windows.windowed_summary(e, "6 hours", "10 minutes"))
    return rounded(out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")))


@query(
    "x02_session_summary",
    f"""WITH g AS (SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER w < INTERVAL 12 HOUR THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS no FROM g)
SELECT user_id, min(ts) AS session_start, count(*) AS n, {fx("sum(value)", 3)} AS total FROM s GROUP BY user_id, no""",
)
def x02_session_summary(spark, sf):
    out = windows.run_closed(windows.event_stream(spark, sf, "events"), lambda e: windows.session_summary(e, "12 hours", "10 minutes"))
    return rounded(out.withColumn("session_start", F.col("session_start").cast("timestamp_ntz")), 3)
