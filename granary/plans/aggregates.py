"""Roll-ups, profiles and other aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions.numeric import correlation, fixed
from granary.operators import encode, profile, relational, rollup
from granary.plans.registry import fx, query
from granary.plans.tables import (
    AS_OF,
    ITEMS_SQL,
    PANEL_SQL,
    SESSIONS_SQL,
    TXNS_SQL,
    items,
    panel,
    sessions,
    table,
    txns,
)
from granary.session import durable

# columns and aggregates of the session roll-up (fixed values)
SESSION_SPEC = {
    "hits": ["sum", "min", "max", "mean", "median"],
    "pageviews": ["sum", "min", "max", "mean", "median"],
    "bounces": ["sum", "mean", "median"],
    **{c: ["min", "max", "mean", "median", "var", "std"] for c in ("sess_dow", "sess_dom", "sess_hour")},
}


def rounded(df, digits=4, skip=()):
    """Every floating-point column fixed to ``digits`` places."""
    return df.select(
        *[fixed(F.col(c), digits).alias(c) if t == "double" and c not in skip else F.col(c) for c, t in df.dtypes]
    )


def _spec_sql(spec, prefix=""):
    """The aggregate specification as SQL text."""
    text = {
        "size": "count(*)",
        "count": "count({c})",
        "nunique": "count(DISTINCT {c})",
        "nunique_small": "count(DISTINCT {c})",
        "nunique_bounded": "count(DISTINCT {c})",
        "sum": "sum({c})",
        "mean": fx("avg({c})"),
        "median": fx("median({c})"),
        "min": "min({c})",
        "max": "max({c})",
        "var": fx("var_samp({c})"),
        "std": fx("stddev_samp({c})"),
        "ptp": "max({c}) - min({c})",
    }
    floats = {"amount"}
    parts = []
    for column, names in spec.items():
        for n in names:
            expr = text[n].format(c=column)
            if n == "sum" and column not in floats:
                expr = f"CAST({expr} AS BIGINT)"
            elif n in ("sum", "min", "max") and column in floats:
                expr = fx(expr)
            parts.append(f"{expr} AS {prefix}{column}_{n.split('_')[0]}")
    return ",\n  ".join(parts)


@query(
    "a01_session_rollup",
    f"""WITH {SESSIONS_SQL}
SELECT visitor, min(ts) AS ts_min, max(ts) AS ts_max,
  {fx("ln(1 + coalesce(sum(revenue), 0))")} AS revenue_sum, count(*) AS revenue_size,
  {_spec_sql(SESSION_SPEC)},
  CAST(floor((floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 86400) AS BIGINT) AS date_diff
FROM sessions GROUP BY visitor""",
)
def a01_session_rollup(spark, sf):
    return rounded(rollup.session_rollup(sessions(spark, sf), "visitor", "ts", "revenue", SESSION_SPEC))


@query(
    "a01b_session_rollup_sum_of_logs",
    f"""WITH {SESSIONS_SQL}
SELECT visitor, min(ts) AS ts_min, max(ts) AS ts_max,
  {fx("coalesce(sum(ln(1 + revenue)), 0)")} AS revenue_sum, count(*) AS revenue_size,
  CAST(sum(hits) AS BIGINT) AS hits_sum,
  CAST(floor((floor(epoch(max(ts))) - floor(epoch(min(ts)))) / 86400) AS BIGINT) AS date_diff
FROM sessions GROUP BY visitor""",
)
def a01b_session_rollup_sum_of_logs(spark, sf):
    return rounded(rollup.session_rollup(sessions(spark, sf), "visitor", "ts", "revenue", {"hits": ["sum"]}, True))


PREPARED_SQL = f"""{TXNS_SQL}, prepared AS (
  SELECT *, CAST(month(purchase_ts) AS INT) AS purchase_month, CAST(epoch(purchase_ts) AS BIGINT) AS purchase_epoch,
    CAST(floor(floor((epoch(TIMESTAMP '{AS_OF}') - epoch(purchase_ts)) / 86400) / 30) AS BIGINT) + month_lag AS month_diff,
    {", ".join(f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS {c}_{v}" for c, vs in rollup.LEVELS.items() for v in vs)}
  FROM txns)"""


@query(
    "a02_card_rollup",
    f"""WITH {PREPARED_SQL}
SELECT card, count(*) AS transactions_count, {_spec_sql(rollup.CARD_SPEC)} FROM prepared GROUP BY card""",
)
def a02_card_rollup(spark, sf):
    return rounded(rollup.aggregate_transactions(rollup.prepare_transactions(txns(spark, sf), AS_OF)))


RECENT = -48  # purchases from this month lag on are the second population


def _profile_sql(name, where, p):
    """The profile of one population as SQL text."""
    plain = {k: v for k, v in rollup.PROFILE_SPEC.items() if k not in ("amount", "category_2_mean", "category_3_mean")}
    return f"""{name}_rows AS (SELECT * FROM txns WHERE {where}),
{name}_facts AS (SELECT t.*, c2.m AS category_2_mean, c3.m AS category_3_mean, year(purchase_ts) AS year, week(purchase_ts) AS week,
    month(purchase_ts) AS month, isodow(purchase_ts) - 1 AS dow,
    CASE WHEN isodow(purchase_ts) >= 6 THEN 1 ELSE 0 END AS weekend, hour(purchase_ts) AS hour,
    CAST(floor(floor((epoch(TIMESTAMP '{AS_OF}') - epoch(purchase_ts)) / 86400) / 30) AS BIGINT) + month_lag AS month_diff
  FROM {name}_rows t LEFT JOIN (SELECT category_2 AS k, avg(amount) AS m FROM {name}_rows GROUP BY 1) c2 ON category_2 = c2.k
  LEFT JOIN (SELECT category_3 AS k, avg(amount) AS m FROM {name}_rows GROUP BY 1) c3 ON category_3 = c3.k),
{name}_agg AS (SELECT card, {_spec_sql(plain, p)},
    {fx("sum(amount)")} AS {p}amount_sum, {fx("max(amount)")} AS {p}amount_max, {fx("min(amount)")} AS {p}amount_min,
    {fx("avg(amount)")} AS {p}amount_mean, {fx("var_samp(amount / 1000)")} AS {p}amount_var,
    {fx("avg(category_2_mean)")} AS {p}category_2_mean_mean, {fx("avg(category_3_mean)")} AS {p}category_3_mean_mean
  FROM {name}_facts GROUP BY card),
{name} AS (SELECT *, CAST(floor((epoch({p}purchase_ts_max) - epoch({p}purchase_ts_min)) / 86400) AS BIGINT) AS {p}purchase_date_diff,
  {fx(f"floor((epoch({p}purchase_ts_max) - epoch({p}purchase_ts_min)) / 86400) / {p}card_size")} AS {p}purchase_date_average,
  CAST(floor((epoch(TIMESTAMP '{AS_OF}') - epoch({p}purchase_ts_max)) / 86400) AS BIGINT) AS {p}purchase_date_uptonow FROM {name}_agg)"""


@query(
    "a03_card_profile",
    f"""WITH {TXNS_SQL}, {_profile_sql("old", f"month_lag < {RECENT}", "hist_")}, {_profile_sql("new", f"month_lag >= {RECENT}", "new_hist_")}
SELECT c_custkey AS card, old.* EXCLUDE (card), new.* EXCLUDE (card) FROM customer LEFT JOIN old ON c_custkey = old.card
LEFT JOIN new ON c_custkey = new.card""",
)
def a03_card_profile(spark, sf):
    """Profiles of both populations on every card; the joined facts are written once and read from there."""
    facts, cards = durable(txns(spark, sf)), table(spark, sf, "customer").select(F.col("c_custkey").alias("card"))
    parts = [
        rollup.card_profile(facts.filter(where), AS_OF, prefix)
        for where, prefix in ((F.col("month_lag") < RECENT, "hist_"), (F.col("month_lag") >= RECENT, "new_hist_"))
    ]
    out = relational.join_features(cards, parts, "card")
    # the variance of amounts is shown in thousands squared
    return rounded(out.withColumns({f"{p}amount_var": F.col(f"{p}amount_var") / 1e6 for p in ("hist_", "new_hist_")}))


# feature specification, fixed values
MONTH_SPEC = {c: ["count", "sum", "mean", "min", "max", "std"] for c in ("amount", "installments")}
_month_measures = ["month_lag"] + [f"{c}_{n}" for c, ns in MONTH_SPEC.items() for n in ns]


def months_sql(source):
    """Per (card, month), then mean and deviation over the months, as SQL text."""
    names = {"mean": "avg", "std": "stddev_samp"}
    first = ", ".join(f"{names.get(n, n)}({c}) AS {c}_{n}" for c, ns in MONTH_SPEC.items() for n in ns)
    second = ", ".join(f"{fx(f'avg({m})')} AS {m}_mean, {fx(f'stddev_samp({m})')} AS {m}_std" for m in _month_measures)
    return f"""first AS (SELECT card, month_lag, {first} FROM {source} GROUP BY 1, 2),
months AS (SELECT card, {second} FROM first GROUP BY card)"""


@query(
    "a04_aggregate_per_month",
    f"""WITH {TXNS_SQL}, {months_sql("txns")} SELECT * FROM months""",
)
def a04_aggregate_per_month(spark, sf):
    return rounded(rollup.aggregate_per_period(txns(spark, sf), "card", "month_lag", MONTH_SPEC))


@query(
    "a05_successive_aggregates",
    f"""WITH {TXNS_SQL}, first AS (SELECT card, installments, avg(amount) AS m FROM txns GROUP BY 1, 2)
SELECT card, {fx("avg(m)")} AS installments_amount_mean, {fx("min(m)")} AS installments_amount_min,
  {fx("max(m)")} AS installments_amount_max, {fx("stddev_samp(m)")} AS installments_amount_std FROM first GROUP BY card""",
)
def a05_successive_aggregates(spark, sf):
    return rounded(rollup.successive_aggregates(txns(spark, sf), "card", "installments", "amount"))


@query(
    "a06_category_summary",
    f"""WITH {SESSIONS_SQL} SELECT channel, count(*) AS size, count(revenue) AS non_null, {fx("avg(revenue)")} AS mean
FROM sessions GROUP BY channel""",
)
def a06_category_summary(spark, sf):
    return rounded(rollup.category_summary(sessions(spark, sf), "channel", "revenue"))


@query(
    "a07_visitor_target",
    f"""WITH {SESSIONS_SQL} SELECT visitor, {fx("ln(1 + sum(exp(greatest(ln(1 + hits) - 2, 0.0)) - 1))", 5)} AS target
FROM sessions GROUP BY visitor""",
)
def a07_visitor_target(spark, sf):
    # the stand-in prediction of a visit is a shifted log of its hits; some are negative
    return rounded(rollup.entity_target(sessions(spark, sf), "visitor", F.log1p("hits") - 2), 5)


@query(
    "a08_value_counts",
    f"""SELECT p_brand, n, {fx("n / total", 6)} AS share FROM
(SELECT p_brand, count(*) AS n, sum(count(*)) OVER () AS total FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
ORDER BY n DESC, p_brand LIMIT 10""",
)
def a08_value_counts(spark, sf):
    li = table(spark, sf, "lineitem").select("l_partkey")
    p = table(spark, sf, "part").select("p_partkey", "p_brand")
    sold = li.join(p, F.col("l_partkey") == F.col("p_partkey")).select("p_brand")
    return rounded(rollup.value_counts(sold, "p_brand", 10), 6)


@query(
    "a09_lump_by_share",
    """WITH f AS (SELECT p_type, p_size, count(*) OVER (PARTITION BY p_type) AS n, count(*) OVER () AS total FROM part)
SELECT CASE WHEN n / total >= 0.165 THEN p_type ELSE 'Other' END AS level, count(*) AS n FROM f GROUP BY 1""",
)
def a09_lump_by_share(spark, sf):
    lumped = encode.lump_rare(table(spark, sf, "part"), "p_type", share=0.165)
    return lumped.groupBy(F.col("p_type").alias("level")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "a09b_lump_top_levels",
    """WITH d AS (SELECT nullif(source, 'src3') AS source FROM documents),
top AS (SELECT source, count(*) AS n FROM d WHERE source IS NOT NULL GROUP BY 1 ORDER BY n DESC, source LIMIT 5)
SELECT CASE WHEN d.source IS NULL THEN '(missing)' WHEN top.source IS NULL THEN 'Other' ELSE d.source END AS level,
  count(*) AS n FROM d LEFT JOIN top ON d.source = top.source GROUP BY 1""",
)
def a09b_lump_top_levels(spark, sf):
    docs = table(spark, sf, "documents").select(F.nullif("source", F.lit("src3")).alias("source"))
    lumped = encode.lump_rare(docs, "source", top=5, missing="(missing)")
    return lumped.groupBy(F.col("source").alias("level")).agg(F.count(F.lit(1)).alias("n"))


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "a10_crosstab_counts",
    f"""SELECT user_id, {", ".join(f"count(*) FILTER (event_type = '{t}') AS {t}" for t in EVENT_TYPES)}
FROM events GROUP BY user_id""",
)
def a10_crosstab_counts(spark, sf):
    return rollup.crosstab(table(spark, sf, "events"), "user_id", "event_type", EVENT_TYPES)


@query(
    "a10b_crosstab_shares",
    f"""SELECT weekday, {", ".join(fx(f"count(*) FILTER (event_type = '{t}') / count(*)") + f" AS {t}" for t in EVENT_TYPES)}
FROM (SELECT CAST(isodow(ts) - 1 AS INT) AS weekday, event_type FROM events) GROUP BY weekday""",
)
def a10b_crosstab_shares(spark, sf):
    e = table(spark, sf, "events").select(F.weekday("ts").alias("weekday"), "event_type")
    return rounded(rollup.normalised(rollup.crosstab(e, "weekday", "event_type", EVENT_TYPES), EVENT_TYPES))


@query(
    "a10c_crosstab_sums",
    f"""SELECT weekday, {", ".join(fx(f"coalesce(sum(value) FILTER (event_type = '{t}'), 0)", 3) + f" AS {t}" for t in EVENT_TYPES)}
FROM (SELECT CAST(isodow(ts) - 1 AS INT) AS weekday, event_type, value FROM events) GROUP BY weekday""",
)
def a10c_crosstab_sums(spark, sf):
    e = table(spark, sf, "events").select(F.weekday("ts").alias("weekday"), "event_type", "value")
    return rounded(rollup.crosstab(e, "weekday", "event_type", EVENT_TYPES, F.col("value")), 3)


ITEM_COLUMNS = ["name", "brand", "category", "price"]


@query(
    "a11_missing_profile",
    f"WITH {ITEMS_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS missing, "
        f"{fx(f'count(*) FILTER ({c} IS NULL) * 100.0 / count(*)')} AS percent FROM items"
        for c in ITEM_COLUMNS
    ),
)
def a11_missing_profile(spark, sf):
    return rounded(profile.missing_profile(items(spark, sf), ITEM_COLUMNS))


NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "a12_numeric_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, {fx(f"avg({c})", 3)} AS mean, {fx(f"stddev_samp({c})", 3)} AS std,
{fx(f"min({c})", 3)} AS min, {fx(f"quantile_cont({c}, 0.25)", 3)} AS q1, {fx(f"quantile_cont({c}, 0.5)", 3)} AS q2,
{fx(f"quantile_cont({c}, 0.75)", 3)} AS q3, {fx(f"max({c})", 3)} AS max, {fx(f"1 - count({c}) / count(*)")} AS missing_share
FROM lineitem"""
        for c in NUMERIC
    ),
)
def a12_numeric_profile(spark, sf):
    return profile.numeric_profile(table(spark, sf, "lineitem"), NUMERIC)


ORDER_COLUMNS = ["o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"]


@query(
    "a13_distinct_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS \"distinct\" FROM orders" for c in ORDER_COLUMNS
    ),
)
def a13_distinct_counts(spark, sf):
    return profile.distinct_counts(table(spark, sf, "orders"), ORDER_COLUMNS)


@query("a13b_approx_distinct_counts")
def a13b_approx_distinct_counts(spark, sf):
    return profile.distinct_counts(table(spark, sf, "orders"), ORDER_COLUMNS, approximate=True)


HALF = "2024-01-16 00:00:00"


@query(
    "a14_key_overlap",
    f"""WITH a AS (SELECT DISTINCT user_id FROM events WHERE ts < TIMESTAMP '{HALF}' AND event_type = 'purchase'),
b AS (SELECT DISTINCT user_id FROM events WHERE ts >= TIMESTAMP '{HALF}' AND event_type = 'purchase')
SELECT (SELECT count(*) FROM a) AS left_keys, (SELECT count(*) FROM b) AS right_keys,
 (SELECT count(*) FROM (SELECT * FROM a INTERSECT SELECT * FROM b)) AS common_keys""",
)
def a14_key_overlap(spark, sf):
    e = table(spark, sf, "events").filter(F.col("event_type") == "purchase")
    cut = F.to_timestamp_ntz(F.lit(HALF))
    return profile.key_overlap(e.filter(F.col("ts") < cut), e.filter(F.col("ts") >= cut), "user_id")


@query(
    "a15_nonzero_share",
    f"""WITH {SESSIONS_SQL}, per AS (SELECT visitor, max(CASE WHEN revenue > 20 THEN 1 ELSE 0 END) AS h FROM sessions GROUP BY 1)
SELECT {fx("(SELECT avg(CASE WHEN revenue > 20 THEN 1.0 ELSE 0.0 END) FROM sessions)")} AS row_share,
 {fx("(SELECT avg(h) FROM per)")} AS entity_share""",
)
def a15_nonzero_share(spark, sf):
    s = sessions(spark, sf).withColumn("gain", F.coalesce(F.col("revenue"), F.lit(0.0)) - 20)
    return rounded(profile.nonzero_share(s, "visitor", "gain"))


@query(
    "a16_shape_moments",
    f"""WITH m AS (SELECT event_type, count(*) AS n, avg(value) AS mu FROM events GROUP BY 1)
SELECT e.event_type, {fx("avg((value - mu) ** 3) / avg((value - mu) ** 2) ** 1.5")} AS skew,
 {fx("avg((value - mu) ** 4) / avg((value - mu) ** 2) ** 2 - 3")} AS excess_kurtosis
FROM events e JOIN m ON e.event_type = m.event_type GROUP BY 1""",
)
def a16_shape_moments(spark, sf):
    e = table(spark, sf, "events")
    return rounded(
        e.groupBy("event_type").agg(F.skewness("value").alias("skew"), F.kurtosis("value").alias("excess_kurtosis"))
    )


@query(
    "a17_sigma_outliers",
    f"""WITH s AS (SELECT avg(value) - 3 * stddev_pop(value) AS lo, avg(value) + 3 * stddev_pop(value) AS hi FROM events)
SELECT {fx("lo")} AS lower_bound, {fx("hi")} AS upper_bound, count(*) FILTER (value < lo) AS below,
 count(*) FILTER (value > hi) AS above, count(value) AS total FROM events, s GROUP BY lo, hi""",
)
def a17_sigma_outliers(spark, sf):
    return rounded(profile.sigma_outliers(table(spark, sf, "events"), "value"))


@query(
    "a18_box_statistics",
    f"""WITH q AS (SELECT l_returnflag, l_linestatus, quantile_cont(l_extendedprice, 0.25) AS q1,
 quantile_cont(l_extendedprice, 0.5) AS median, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1, 2)
SELECT l_returnflag, l_linestatus, {fx("q1")} AS q1, {fx("median")} AS median, {fx("q3")} AS q3,
 {fx("q1 - 1.5 * (q3 - q1)")} AS lower_fence, {fx("q3 + 1.5 * (q3 - q1)")} AS upper_fence FROM q""",
)
def a18_box_statistics(spark, sf):
    return rounded(profile.box_statistics(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice"))


@query(
    "a19_correlation_pairs",
    " UNION ALL ".join(
        f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", {fx(f'corr({a}, {b})')} AS corr FROM lineitem"
        for i, a in enumerate(NUMERIC)
        for b in NUMERIC[i + 1 :]
    ),
)
def a19_correlation_pairs(spark, sf):
    return profile.correlation_pairs(table(spark, sf, "lineitem"), NUMERIC)


@query(
    "a19b_onehot_target_correlation",
    " UNION ALL ".join(
        f"SELECT '{t}' AS level, {fx(f'''corr(CASE WHEN event_type = '{t}' THEN 1.0 ELSE 0.0 END, value)''')} AS corr FROM events"
        for t in EVENT_TYPES
    ),
)
def a19b_onehot_target_correlation(spark, sf):
    e = table(spark, sf, "events")
    one = e.agg(*[correlation(F.col("event_type") == t, F.col("value")).alias(t) for t in EVENT_TYPES])
    return rounded(one.unpivot([], EVENT_TYPES, "level", "corr"))


@query(
    "a20_group_median",
    f"WITH {ITEMS_SQL} SELECT brand, condition, {fx('median(price)')} AS median FROM items WHERE brand IS NOT NULL GROUP BY 1, 2",
)
def a20_group_median(spark, sf):
    return rounded(rollup.group_medians(items(spark, sf), ["brand", "condition"], "price"))


@query(
    "a21_melted_summary",
    f"""WITH {SESSIONS_SQL}, g AS (SELECT sess_dow, CAST(count(*) AS DOUBLE) AS visits, avg(revenue) AS mean, sum(revenue) AS total
  FROM sessions GROUP BY 1)
SELECT sess_dow, 'visits' AS metric, {fx("visits", 3)} AS value FROM g UNION ALL
SELECT sess_dow, 'mean', {fx("mean", 3)} FROM g UNION ALL SELECT sess_dow, 'total', {fx("total", 3)} FROM g""",
)
def a21_melted_summary(spark, sf):
    return rounded(rollup.melt_summary(sessions(spark, sf), "sess_dow", "revenue"), 3)


@query(
    "a22_flow_table",
    """WITH j AS (SELECT c_mktsegment AS segment, event_type, value > 50 AS hit FROM events JOIN customer ON user_id = c_custkey),
f AS (SELECT segment, count(*) / (SELECT count(*) FROM j) AS p FROM j GROUP BY 1),
g AS (SELECT event_type, count(*) AS n FROM j GROUP BY 1 ORDER BY n DESC, event_type LIMIT 3)
SELECT CASE WHEN p >= 0.2 THEN j.segment ELSE 'Other' END AS segment,
 CASE WHEN event_type IN (SELECT event_type FROM g) THEN event_type ELSE 'Other' END AS event_type,
 CASE WHEN hit THEN 'non-zero' ELSE 'zero' END AS outcome, count(*) AS n
FROM j JOIN f ON j.segment = f.segment GROUP BY 1, 2, 3""",
)
def a22_flow_table(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", "value")
    c = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    j = e.join(c, F.col("user_id") == F.col("c_custkey"))
    j = encode.lump_rare(j, "segment", share=0.2)
    j = encode.lump_rare(j, "event_type", top=3)
    outcome = F.when(F.col("value") > 50, "non-zero").otherwise("zero").alias("outcome")
    return j.groupBy("segment", "event_type", outcome).agg(F.count(F.lit(1)).alias("n"))


@query(
    "a23_hierarchy_totals",
    f"""SELECT p_type, p_brand, p_size, count(*) AS n, {fx("sum(p_retailprice)", 2)} AS total,
 CAST(grouping_id(p_type, p_brand, p_size) AS INT) AS depth_code FROM part GROUP BY ROLLUP (p_type, p_brand, p_size)""",
)
def a23_hierarchy_totals(spark, sf):
    return rounded(rollup.hierarchy_totals(table(spark, sf, "part"), ["p_type", "p_brand", "p_size"], "p_retailprice"), 2)


@query(
    "a24_wide_to_long",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'quantity' AS measure, l_quantity AS value FROM lineitem UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'discount', l_discount FROM lineitem UNION ALL
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'tax', l_tax FROM lineitem""",
)
def a24_wide_to_long(spark, sf):
    ids = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    li = table(spark, sf, "lineitem").select(
        *ids, F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"), F.col("l_tax").alias("tax")
    )
    return li.unpivot(ids, ["quantity", "discount", "tax"], "measure", "value")


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "a25_long_to_wide",
    f"""WITH {PANEL_SQL} SELECT d, nation, {", ".join(f"{fx(f'''max(y) FILTER (segment = '{s}')''', 2)} AS {s.lower()}" for s in SEGMENTS)}
FROM panel GROUP BY d, nation""",
)
def a25_long_to_wide(spark, sf):
    p = panel(spark, sf).withColumn("segment", F.lower("segment"))
    return rounded(p.groupBy("d", "nation").pivot("segment", [s.lower() for s in SEGMENTS]).agg(F.max("y")), 2)


@query(
    "a27_mean_per_bin",
    f"""WITH b AS (SELECT CASE WHEN c_acctbal > -1000 AND c_acctbal <= 0 THEN 0 WHEN c_acctbal > 0 AND c_acctbal <= 2500 THEN 1
 WHEN c_acctbal > 2500 AND c_acctbal <= 5000 THEN 2 WHEN c_acctbal > 5000 AND c_acctbal <= 10000 THEN 3 END AS bin, c_acctbal
 FROM customer)
SELECT bin, count(*) AS n, {fx("avg(c_acctbal)")} AS mean FROM b WHERE bin IS NOT NULL GROUP BY bin""",
)
def a27_mean_per_bin(spark, sf):
    c = table(spark, sf, "customer")
    binned = c.withColumn("bin", encode.fixed_bins(F.col("c_acctbal"), [-1000, 0, 2500, 5000, 10000]))
    out = binned.dropna(subset=["bin"]).groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg("c_acctbal").alias("mean"))
    return rounded(out)


YEARS = [1995, 1996, 1997, 1998, 1999, 2000, 2001]


@query(
    "a28_month_profile",
    f"""SELECT CAST(month(o_orderdate) AS INT) AS month,
 {", ".join(fx(f"coalesce(avg(o_totalprice) FILTER (year(o_orderdate) = {y}), 0)", 3) + f" AS y{y}" for y in YEARS)}
FROM orders GROUP BY 1""",
)
def a28_month_profile(spark, sf):
    o = table(spark, sf, "orders").select(
        F.month("o_orderdate").alias("month"), F.concat(F.lit("y"), F.year("o_orderdate")).alias("year"), "o_totalprice"
    )
    names = [f"y{y}" for y in YEARS]
    return rounded(o.groupBy("month").pivot("year", names).agg(F.avg("o_totalprice")).fillna(0.0, subset=names), 3)


@query(
    "a29_calendar_means",
    f"""WITH {PANEL_SQL} SELECT CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter, CAST(isodow(d) - 1 AS INT) AS dow,
 segment, {fx("avg(y)", 3)} AS mean FROM panel GROUP BY 1, 2, 3, 4""",
)
def a29_calendar_means(spark, sf):
    p = panel(spark, sf)
    return rounded(
        p.groupBy(
            F.year("d").alias("year"), F.quarter("d").alias("quarter"), F.weekday("d").alias("dow"), "segment"
        ).agg(F.avg("y").alias("mean")),
        3,
    )


@query(
    "a30_shared_histogram",
    f"""WITH b AS (SELECT min(l_extendedprice) AS lo, (max(l_extendedprice) - min(l_extendedprice)) / 20 AS w FROM lineitem),
h AS (SELECT l_returnflag, CAST(least(floor((l_extendedprice - lo) / w), 19) AS INT) AS bin, lo, w FROM lineitem, b),
c AS (SELECT l_returnflag, bin, lo, w, count(*) AS n FROM h GROUP BY ALL)
SELECT l_returnflag, bin, n, {fx("lo + bin * w", 3)} AS left_edge,
 {fx("1000 * n / sum(n) OVER (PARTITION BY l_returnflag) / w", 6)} AS density FROM c""",
)
def a30_shared_histogram(spark, sf):
    h = rollup.shared_histogram(table(spark, sf, "lineitem"), "l_returnflag", "l_extendedprice", 20)
    return h.select(
        "l_returnflag",
        "bin",
        "n",
        fixed(F.col("left_edge"), 3).alias("left_edge"),
        fixed(F.col("density") * 1000, 6).alias("density"),
    )


@query(
    "a31_intraclass_correlation",
    f"""WITH g AS (SELECT user_id, count(*) AS n, avg(value) AS m, var_pop(value) AS v FROM events GROUP BY 1),
s AS (SELECT count(*) AS k, sum(n) AS n, sum(n * n) AS n2, sum(n * v) AS ssw,
 sum(n * m * m) - sum(n * m) ** 2 / sum(n) AS ssb FROM g),
v AS (SELECT k, n, ssb / (k - 1) AS msb, ssw / (n - k) AS msw, (n - n2 / n) / (k - 1) AS n0 FROM s)
SELECT k, CAST(n AS BIGINT) AS n, {fx("msb", 3)} AS ms_between, {fx("msw", 3)} AS ms_within,
 {fx("((msb - msw) / n0) / ((msb - msw) / n0 + msw)", 6)} AS icc FROM v""",
)
def a31_intraclass_correlation(spark, sf):
    out = rollup.intraclass_correlation(table(spark, sf, "events"), "user_id", "value")
    return out.select(
        "k", "n", *[fixed(F.col(c), 3).alias(c) for c in ("ms_between", "ms_within")], fixed(F.col("icc"), 6).alias("icc")
    )


@query(
    "a32_first_valid",
    """WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d, o_orderkey,
  CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS status, CASE WHEN o_totalprice > 200000 THEN o_orderpriority END AS priority
  FROM orders)
SELECT d, min_by(status, o_orderkey) FILTER (status IS NOT NULL) AS status,
 min_by(priority, o_orderkey) FILTER (priority IS NOT NULL) AS priority FROM o GROUP BY d""",
)
def a32_first_valid(spark, sf):
    o = table(spark, sf, "orders").select(
        F.to_date("o_orderdate").alias("d"),
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_totalprice") > 200000, F.col("o_orderpriority")).alias("priority"),
    )
    return rollup.first_valid(o, "d", F.col("o_orderkey"), ["status", "priority"])


@query("a33_time_range", "SELECT min(o_orderdate) AS first_ts, max(o_orderdate) AS last_ts, count(*) AS n FROM orders")
def a33_time_range(spark, sf):
    return table(spark, sf, "orders").agg(
        F.min("o_orderdate").alias("first_ts"), F.max("o_orderdate").alias("last_ts"), F.count(F.lit(1)).alias("n")
    )


@query(
    "a34_majority_vote",
    f"""WITH v AS (SELECT l.doc_id, quality AS v1, CASE WHEN n_chars > 1500 THEN 1 ELSE 0 END AS v2,
  CASE WHEN lang = 'en' THEN 1 ELSE 0 END AS v3 FROM labels l JOIN documents d ON l.doc_id = d.doc_id)
SELECT doc_id, CASE WHEN v1 + v2 + v3 >= 2 THEN 1 ELSE 0 END AS vote,
 {fx("ln(1 + ((exp(v1) - 1) + (exp(v2) - 1) + (exp(v3) - 1)) / 3)")} AS blended FROM v""",
)
def a34_majority_vote(spark, sf):
    lab = table(spark, sf, "labels")
    doc = table(spark, sf, "documents").select("doc_id", "n_chars", "lang")
    j = lab.join(doc, "doc_id")
    votes = [F.col("quality"), (F.col("n_chars") > 1500).cast("int"), (F.col("lang") == "en").cast("int")]
    return j.select(
        "doc_id",
        rollup.majority_vote(votes).alias("vote"),
        fixed(rollup.log_mean([v.cast("double") for v in votes])).alias("blended"),
    )


@query(
    "a35_transpose",
    f"""WITH y AS (SELECT o_orderstatus, {", ".join(f"count(*) FILTER (year(o_orderdate) = {y}) AS y{y}" for y in YEARS)} FROM orders GROUP BY 1)
"""
    + " UNION ALL ".join(
        f"SELECT 'y{y}' AS key, " + ", ".join(f"max(y{y}) FILTER (o_orderstatus = '{s}') AS {s}" for s in "FOP") + " FROM y"
        for y in YEARS
    ),
)
def a35_transpose(spark, sf):
    o = table(spark, sf, "orders").select("o_orderstatus", F.concat(F.lit("y"), F.year("o_orderdate")).alias("year"))
    names = [f"y{y}" for y in YEARS]
    counts = o.groupBy("o_orderstatus").pivot("year", names).agg(F.count(F.lit(1))).fillna(0, subset=names)
    return counts.transpose("o_orderstatus")


@query(
    "a36_ratio_of_aggregates",
    f"""SELECT n_name, {fx("ln(nullif(sum(o_totalprice), 0)) / count(*)", 6)} AS log_total_per_order
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""",
)
def a36_ratio_of_aggregates(spark, sf):
    o = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sum("o_totalprice").alias("s"), F.count(F.lit(1)).alias("c"))
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    per = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    ratio = F.ln(F.nullif(F.sum("s"), F.lit(0.0))) / F.sum("c")
    return per.groupBy("n_name").agg(fixed(ratio, 6).alias("log_total_per_order"))


@query(
    "a37_having",
    f"""SELECT source, lang, count(*) AS n, {fx("avg(n_chars)", 3)} AS mean_chars FROM documents GROUP BY 1, 2
HAVING count(*) >= 8 AND sum(n_chars) > 0""",
)
def a37_having(spark, sf):
    d = table(spark, sf, "documents")
    grouped = d.groupBy("source", "lang").agg(
        F.count(F.lit(1)).alias("n"), F.avg("n_chars").alias("mean_chars"), F.sum("n_chars").alias("total")
    )
    return rounded(grouped.filter((F.col("n") >= 8) & (F.col("total") > 0)).drop("total"), 3)
