"""Date and math scalar queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from granary.functions import dates
from granary.functions.numeric import fixed
from granary.operators import clean
from granary.plans.aggregates import rounded
from granary.plans.projections import LINE_KEY, LINE_KEY_SQL
from granary.plans.registry import fx, query
from granary.plans.tables import AS_OF, DAILY_SQL, TXNS_SQL, daily, table, txns


@query(
    "d01_calendar_parts",
    """SELECT event_id, CAST(year(ts) AS INT) AS year, CAST(quarter(ts) AS INT) AS quarter, CAST(month(ts) AS INT) AS month,
 CAST(week(ts) AS INT) AS week, CAST(day(ts) AS INT) AS day, CAST(isodow(ts) - 1 AS INT) AS dow, CAST(hour(ts) AS INT) AS hour,
 dayname(ts) AS day_name, strftime(ts, '%b') AS month_abbr FROM events""",
)
def d01_calendar_parts(spark, sf):
    parts = dates.calendar_parts(F.col("ts"))
    return table(spark, sf, "events").select("event_id", *[e.alias(n) for n, e in parts.items()])


@query(
    "d02_epoch",
    """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, strftime(ts, '%Y-%m-%d %H:%M:%S') AS back FROM events""",
)
def d02_epoch(spark, sf):
    seconds = dates.epoch_seconds(F.col("ts"))
    back = F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd HH:mm:ss")
    return table(spark, sf, "events").select("event_id", seconds.alias("seconds"), back.alias("back"))


@query(
    "d03_day_differences",
    f"""WITH {TXNS_SQL} SELECT l_orderkey, l_linenumber, l_partkey, merchant,
 CAST(floor((epoch(TIMESTAMP '{AS_OF}') - epoch(purchase_ts)) / 86400) AS BIGINT) AS days,
 CAST(floor(floor((epoch(TIMESTAMP '{AS_OF}') - epoch(purchase_ts)) / 86400) / 30) AS BIGINT) + month_lag AS month_diff FROM txns""",
)
def d03_day_differences(spark, sf):
    return txns(spark, sf).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "merchant",
        dates.whole_days_between(F.lit(AS_OF).cast("timestamp"), F.col("purchase_ts")).alias("days"),
        dates.months_elapsed(AS_OF, F.col("purchase_ts"), F.col("month_lag")).alias("month_diff"),
    )


@query(
    "d04_season_flags",
    """SELECT o_orderkey, CASE WHEN isodow(o_orderdate) >= 6 THEN 1 ELSE 0 END AS weekend,
 CASE WHEN month(o_orderdate) IN (4, 5, 8, 9) THEN 1 ELSE 0 END AS school_season FROM orders""",
)
def d04_season_flags(spark, sf):
    ts = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        dates.is_weekend(ts).alias("weekend"),
        dates.in_months(ts, (4, 5, 8, 9)).alias("school_season"),
    )


_TURN = 2 * math.pi / 7


@query(
    "d05_trend_and_fourier",
    f"""WITH {DAILY_SQL}, spine AS (SELECT CAST(unnest(generate_series((SELECT min(d) FROM daily), (SELECT max(d) FROM daily) + 16, INTERVAL 1 DAY)) AS DATE) AS d),
t AS (SELECT d, d - (SELECT min(d) FROM daily) + 1 AS trend, CASE WHEN d > (SELECT max(d) FROM daily) THEN 1 ELSE 0 END AS ahead, (isodow(d) - 1) * {_TURN!r} AS p FROM spine)
SELECT d, CAST(trend AS BIGINT) AS trend, ahead, {", ".join(f"{fx(f'sin({k} * p)')} AS sin_{k}, {fx(f'cos({k} * p)')} AS cos_{k}" for k in (1, 2, 3))} FROM t""",
)
def d05_trend_and_fourier(spark, sf):
    """Trend and weekly terms over the observed days and 16 days beyond."""
    days = daily(spark, sf).select("d")
    first, last = days.agg(F.min("d")).scalar(), days.agg(F.max("d")).scalar()
    span = days.agg(F.min("d").alias("a"), F.date_add(F.max("d"), 16).alias("b"))
    spine = span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("d"))
    terms = dates.weekly_fourier(F.col("d"), 4)
    return spine.select(
        "d",
        (F.date_diff(F.col("d"), first) + 1).cast("long").alias("trend"),
        (F.col("d") > last).cast("int").alias("ahead"),
        *[fixed(e).alias(n) for n, e in terms.items()],
    )


@query(
    "d06_month_counts",
    "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY 1",
)
def d06_month_counts(spark, sf):
    o = table(spark, sf, "orders")
    return o.groupBy(F.trunc(F.to_date("o_orderdate"), "MM").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "m01_log_forms",
    f"""SELECT {LINE_KEY_SQL}, {fx("ln(1 + l_extendedprice)")} AS log1p, {fx("exp(l_discount) - 1", 6)} AS expm1,
 {fx("ln(l_quantity + 1)")} AS log_plus_1, {fx("ln(l_tax + 0.01)")} AS log_plus_cent FROM lineitem""",
)
def m01_log_forms(spark, sf):
    return table(spark, sf, "lineitem").select(
        *LINE_KEY,
        fixed(F.log1p("l_extendedprice")).alias("log1p"),
        fixed(F.expm1("l_discount"), 6).alias("expm1"),
        fixed(F.ln(F.col("l_quantity") + 1)).alias("log_plus_1"),
        fixed(F.ln(F.col("l_tax") + 0.01)).alias("log_plus_cent"),
    )


@query(
    "m02_min_max_scale",
    f"""WITH b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi, min(l_quantity) AS ql, max(l_quantity) AS qh FROM lineitem WHERE l_linestatus = 'F')
SELECT {LINE_KEY_SQL}, {fx("-1 + (l_extendedprice - lo) / (hi - lo) * 2")} AS l_extendedprice, {fx("-1 + (l_quantity - ql) / (qh - ql) * 2")} AS l_quantity FROM lineitem, b""",
)
def m02_min_max_scale(spark, sf):
    li = table(spark, sf, "lineitem").select(*LINE_KEY, "l_linestatus", "l_extendedprice", "l_quantity")
    out = clean.min_max_scale(li.filter("l_linestatus = 'F'"), li, ["l_extendedprice", "l_quantity"], -1.0, 1.0)
    return rounded(out.drop("l_linestatus"))


@query("m02b_min_max_unscale", f"SELECT {LINE_KEY_SQL}, {fx('l_extendedprice', 2)} AS l_extendedprice FROM lineitem")
def m02b_min_max_unscale(spark, sf):
    li = table(spark, sf, "lineitem").select(*LINE_KEY, "l_extendedprice")
    scaled = clean.min_max_scale(li, li, ["l_extendedprice"], -1.0, 1.0)
    return rounded(clean.min_max_unscale(li, scaled, ["l_extendedprice"], -1.0, 1.0), 2)


@query(
    "m03_standardise",
    f"""WITH b AS (SELECT avg(l_extendedprice) AS m, stddev_pop(l_extendedprice) AS s, avg(l_quantity) AS qm, stddev_pop(l_quantity) AS qs FROM lineitem WHERE l_linestatus = 'F')
SELECT {LINE_KEY_SQL}, {fx("(l_extendedprice - m) / s")} AS l_extendedprice, {fx("(l_quantity - qm) / qs")} AS l_quantity FROM lineitem, b""",
)
def m03_standardise(spark, sf):
    li = table(spark, sf, "lineitem").select(*LINE_KEY, "l_linestatus", "l_extendedprice", "l_quantity")
    out = clean.standardise(li.filter("l_linestatus = 'F'"), li, ["l_extendedprice", "l_quantity"])
    return rounded(out.drop("l_linestatus"))


@query(
    "m03b_standardise_sample",
    f"""WITH b AS (SELECT avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS s FROM customer)
SELECT c_custkey, {fx("(c_acctbal - m) / s")} AS c_acctbal FROM customer, b""",
)
def m03b_standardise_sample(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return rounded(clean.standardise(c, c, ["c_acctbal"], sample=True))


@query(
    "m04_robust_scale",
    f"""WITH b AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS q2, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem)
SELECT {LINE_KEY_SQL}, {fx("(l_extendedprice - q2) / (q3 - q1)")} AS l_extendedprice FROM lineitem, b""",
)
def m04_robust_scale(spark, sf):
    li = table(spark, sf, "lineitem").select(*LINE_KEY, "l_extendedprice")
    return rounded(clean.robust_scale(li, li, ["l_extendedprice"]))
