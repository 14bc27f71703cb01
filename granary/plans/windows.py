"""Window queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.operators import text as textops
from granary.operators import windowing
from granary.plans.aggregates import rounded
from granary.plans.registry import fx, query
from granary.plans.tables import ITEMS_SQL, PANEL_SQL, SESSIONS_SQL, TXNS_SQL, items, panel, sessions, table, txns
from granary.session import durable
from granary.plans.texts import docs, words


@query(
    "w01_running_index",
    """SELECT event_id, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id) AS index_in_day,
 row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS index_overall FROM events""",
)
def w01_running_index(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", F.to_date("ts").alias("day"))
    indexed = windowing.running_index(e, ["user_id", "day"], ["event_id"], "index_in_day")
    indexed = windowing.running_index(indexed, ["user_id"], ["event_id"], "index_overall")
    return indexed.select("event_id", "index_in_day", "index_overall")


@query(
    "w02_running_share",
    f"""SELECT event_id, count(*) OVER w AS per_day, {fx("row_number() OVER (w ORDER BY event_id) / count(*) OVER w")} AS running_share
FROM events WINDOW w AS (PARTITION BY user_id, CAST(ts AS DATE))""",
)
def w02_running_share(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", F.to_date("ts").alias("day"))
    indexed = windowing.running_index(e, ["user_id", "day"], ["event_id"], "i")
    total = windowing.attach_aggregates(indexed, ["user_id", "day"], {"per_day": F.count(F.lit(1))})
    return rounded(total.select("event_id", "per_day", (F.col("i") / F.col("per_day")).alias("running_share")))


@query(
    "w03_group_mean",
    f"""WITH {TXNS_SQL} SELECT l_orderkey, l_linenumber, l_partkey, merchant,
 {fx("avg(amount) OVER (PARTITION BY category_3)", 3)} AS category_mean,
 {fx("avg(installments) OVER (PARTITION BY merchant_category, subsector, city, category_1, category_3)", 3)} AS detail_mean FROM txns""",
)
def w03_group_mean(spark, sf):
    t = durable(txns(spark, sf))  # the joined facts are written once and read from there
    t = windowing.attach_aggregates(t, ["category_3"], {"category_mean": F.avg("amount")})
    detail = ["merchant_category", "subsector", "city", "category_1", "category_3"]
    t = windowing.attach_aggregates(t, detail, {"detail_mean": F.avg("installments")})
    return rounded(t.select("l_orderkey", "l_linenumber", "l_partkey", "merchant", "category_mean", "detail_mean"), 3)


@query(
    "w04_group_distinct",
    """WITH m AS (SELECT CAST(ts AS DATE) AS d, count(DISTINCT user_id) AS day_users FROM events GROUP BY 1),
w AS (SELECT CAST(isodow(ts) - 1 AS INT) AS dow, count(DISTINCT user_id) AS dow_users FROM events GROUP BY 1)
SELECT event_id, day_users, dow_users FROM events JOIN m ON CAST(ts AS DATE) = d JOIN w ON isodow(ts) - 1 = dow""",
)
def w04_group_distinct(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", F.to_date("ts").alias("day"), F.weekday("ts").alias("dow"))
    e = windowing.attach_aggregates(e, ["day"], {"day_users": F.count_distinct("user_id")})
    e = windowing.attach_aggregates(e, ["dow"], {"dow_users": F.count_distinct("user_id")})
    return e.select("event_id", "day_users", "dow_users")


@query(
    "w05_running_product",
    f"""WITH {SESSIONS_SQL} SELECT session_id, {fx("product(1 + hits / 1000.0) OVER (PARTITION BY visitor, channel ORDER BY session_id)")} AS growth
FROM sessions""",
)
def w05_running_product(spark, sf):
    s = sessions(spark, sf).select("visitor", "channel", "session_id", (1 + F.col("hits") / 1000.0).alias("factor"))
    out = windowing.running_product(s, ["visitor", "channel"], ["session_id"], F.col("factor"), "growth")
    return rounded(out.select("session_id", "growth"))


@query(
    "w06_group_sum_variance",
    f"""WITH {SESSIONS_SQL} SELECT session_id, CAST(sum(hits) OVER (PARTITION BY visitor, channel) AS BIGINT) AS hits_sum,
 {fx("var_samp(hits) OVER (PARTITION BY visitor, channel)", 3)} AS hits_var FROM sessions""",
)
def w06_group_sum_variance(spark, sf):
    s = sessions(spark, sf).select("session_id", "visitor", "channel", "hits")
    out = windowing.attach_aggregates(
        s, ["visitor", "channel"], {"hits_sum": F.sum("hits"), "hits_var": F.var_samp("hits")}
    )
    return rounded(out.select("session_id", "hits_sum", "hits_var"), 3)


@query(
    "w07_trailing_mean",
    f"""WITH {PANEL_SQL} SELECT d, nation, segment, {fx("CASE WHEN count(y) OVER w = 7 THEN avg(y) OVER w END", 3)} AS mean_7
FROM panel WINDOW w AS (PARTITION BY nation, segment ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
def w07_trailing_mean(spark, sf):
    out = windowing.trailing_mean(panel(spark, sf), ["nation", "segment"], "d", "y", 7, "mean_7")
    return rounded(out.select("d", "nation", "segment", "mean_7"), 3)


@query(
    "w08_lags",
    f"""WITH {PANEL_SQL}, l AS (SELECT d, nation, segment, y, lag(y, 1) OVER w AS y_lag1, lag(y, 2) OVER w AS y_lag2, lag(y, 3) OVER w AS y_lag3
 FROM panel WINDOW w AS (PARTITION BY nation, segment ORDER BY d))
SELECT d, nation, segment, {fx("y", 2)} AS y, {fx("y_lag1", 2)} AS y_lag1, {fx("y_lag2", 2)} AS y_lag2, {fx("y_lag3", 2)} AS y_lag3
FROM l WHERE y_lag3 IS NOT NULL""",
)
def w08_lags(spark, sf):
    return rounded(windowing.lags(panel(spark, sf), ["nation", "segment"], "d", "y", 3, complete=True), 2)


@query(
    "w09_forward_fill",
    f"""WITH {PANEL_SQL}, g AS (SELECT d, nation, segment, CASE WHEN isodow(d) < 6 THEN y END AS y FROM panel)
SELECT d, nation, segment, {fx("last_value(y IGNORE NULLS) OVER (PARTITION BY nation, segment ORDER BY d ROWS UNBOUNDED PRECEDING)", 2)} AS filled FROM g""",
)
def w09_forward_fill(spark, sf):
    p = panel(spark, sf).withColumn("y", F.when(F.weekday("d") < 5, F.col("y")))
    out = windowing.forward_fill(p, ["nation", "segment"], "d", "y", "filled")
    return rounded(out.select("d", "nation", "segment", "filled"), 2)


_ACF_SQL = f"""{PANEL_SQL}, c AS (SELECT d, nation, y - avg(y) OVER (PARTITION BY nation) AS c FROM
 (SELECT d, nation, sum(y) AS y FROM panel GROUP BY 1, 2)),
l AS (SELECT nation, c, {", ".join(f"lag(c, {k}) OVER (PARTITION BY nation ORDER BY d) AS l{k}" for k in range(1, 8))} FROM c),
acf AS (SELECT nation, {", ".join(f"sum(c * l{k}) / sum(c * c) AS acf_{k}" for k in range(1, 8))} FROM l GROUP BY nation)"""


def _acf(spark, sf):
    p = panel(spark, sf).groupBy("d", "nation").agg(F.sum("y").alias("y"))
    return windowing.autocorrelations(p, ["nation"], "d", "y", 7)


@query("w10_autocorrelation", f"WITH {_ACF_SQL} SELECT nation, {', '.join(fx(f'acf_{k}') + f' AS acf_{k}' for k in range(1, 8))} FROM acf")
def w10_autocorrelation(spark, sf):
    return rounded(_acf(spark, sf))


@query(
    "w10b_partial_autocorrelation",
    f"""WITH {_ACF_SQL}, two AS (SELECT *, (acf_2 - acf_1 * acf_1) / (1 - acf_1 * acf_1) AS p2 FROM acf),
three AS (SELECT *, (acf_3 - acf_1 * (1 - p2) * acf_2 - p2 * acf_1) / (1 - acf_1 * (1 - p2) * acf_1 - p2 * acf_2) AS p3 FROM two)
SELECT nation, {fx("acf_1")} AS pacf_1, {fx("p2")} AS pacf_2, {fx("p3")} AS pacf_3 FROM three""",
)
def w10b_partial_autocorrelation(spark, sf):
    return rounded(windowing.partial_autocorrelations(_acf(spark, sf), ["nation"], 3))


@query(
    "w11_run_lengths",
    """WITH p AS (SELECT user_id, event_type IN ('purchase', 'click') AS bit, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS pos FROM events),
o AS (SELECT user_id, pos, pos - row_number() OVER (PARTITION BY user_id ORDER BY pos) AS run FROM p WHERE bit)
SELECT user_id, min(pos) AS start, count(*) AS length FROM o GROUP BY user_id, run""",
)
def w11_run_lengths(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type")
    return windowing.run_lengths(e, ["user_id"], ["event_id"], F.col("event_type").isin("purchase", "click").cast("int"))


@query(
    "w12_top_terms_per_document",
    """WITH t AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS term FROM documents),
c AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY 1, 2)
SELECT doc_id, term, tf, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY tf DESC, term) AS INT) AS rank FROM c
QUALIFY rank <= 3""",
)
def w12_top_terms_per_document(spark, sf):
    return textops.top_terms(textops.term_counts(docs(spark, sf), "doc_id", words()), ["doc_id"], "tf", 3)


@query(
    "w13_share_within_group",
    f"""WITH {ITEMS_SQL}, c AS (SELECT brand, condition, count(*) AS n FROM items WHERE brand IS NOT NULL GROUP BY 1, 2)
SELECT brand, condition, n, {fx("n / sum(n) OVER (PARTITION BY brand)")} AS share FROM c""",
)
def w13_share_within_group(spark, sf):
    return rounded(windowing.shares_within(items(spark, sf), ["brand"], "condition"))
